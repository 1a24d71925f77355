"""Query tables stored in buckets, so that their joins need no shuffle.

The joins of the indicators match tables cell by cell: by scenario, region and year and mostly one more
dimension. A title stored in buckets of (region, year) is already dealt by what all of these share: two such
titles join, and their rows are grouped by these keys, where they lie. Spark takes that for joins on more keys
only if ``spark.sql.requireAllClusterKeysForCoPartition`` is off, which ``copartitioned`` sees to.

Buckets are right for tables whose cells are of similar size. A cell with a third of all rows is one bucket
and one task, which Spark does not split; such titles stay with ``catalog.register_title``.

Spark knows buckets from its catalog alone. A small file beside the data says how a table is dealt, and a
session that meets it declares the table once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from scenlens.sources import catalog

NOTE = "_buckets"
_CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def bucket_keys(title: str) -> list[str]:
    """(region, year), or the title's own place and year."""
    names = catalog.CATALOG[title].schema.names
    return ["region" if "region" in names else names[1], "year"]


def _table_name(path: str) -> str:
    return f"scenlens_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _full(spark: SparkSession, path: str) -> str:
    store, path = _file_system(spark, path)
    return store.makeQualified(path).toString()


def register_bucketed(spark: SparkSession, root: str, title: str, df: DataFrame, buckets: int) -> None:
    """Add a table to a project under a title, dealt to buckets and within each scenario sorted by their keys."""
    schema = catalog.checked_schema(title, df)
    path = _full(spark, f"{root}/{catalog.slug(title)}")
    store, place = _file_system(spark, path)
    if store.exists(place):
        raise FileExistsError(path)
    keys, name = bucket_keys(title), _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.select(*[f"`{c}`" for c in schema.names]).repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = dealt.write.partitionBy("scenario").bucketBy(buckets, *keys).sortBy(*keys)
    writer.format("parquet").option("path", path).saveAsTable(name)
    note = json.dumps({"keys": keys, "buckets": buckets})
    spark.range(0, 1, 1, 1).select(F.lit(note).alias("value")).write.text(f"{path}/{NOTE}")


def is_bucketed(spark: SparkSession, root: str, title: str) -> bool:
    store, place = _file_system(spark, f"{root}/{catalog.slug(title)}/{NOTE}")
    return store.exists(place)


def read_bucketed(spark: SparkSession, root: str, title: str, scenarios: Sequence[str] | None = None) -> DataFrame:
    """The long table of one title that is stored in buckets, for all or some scenarios."""
    path = _full(spark, f"{root}/{catalog.slug(title)}")
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        note = json.loads(spark.read.text(f"{path}/{NOTE}").first().value)
        _declare(spark, name, path, catalog.CATALOG[title].schema, note["keys"], note["buckets"])
    df = spark.table(name).select(*[f"`{c}`" for c in catalog.CATALOG[title].schema.names])
    return df if scenarios is None else df.filter(F.col("scenario").isin(*scenarios))


def _declare(spark: SparkSession, name: str, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (scenario) "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)


@contextmanager
def copartitioned(spark: SparkSession) -> Iterator[None]:
    """Plans that are run inside may join buckets on more keys than they are dealt by."""
    before = spark.conf.get(_CO_PARTITION)
    spark.conf.set(_CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(_CO_PARTITION, before)
