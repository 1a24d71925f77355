"""Small helpers that the operators share."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from scenlens.sources.shipping import ship

_ROW_BITS = 33  # of monotonically_increasing_id(): the row's index in its partition

__all__ = ["bounded_table", "numbered", "partitions", "settings", "ship", "word_count"]


@contextmanager
def settings(spark: SparkSession, **values) -> Iterator[None]:
    """The session's settings for jobs that run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """Rows written into the plan; only for tables whose size a parameter bounds."""
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[str], sums: dict[str, str] | None = None) -> DataFrame:
    """Add ``position``, the 0-based rank of each row in ``order``, and running sums before the row.

    ``sums`` maps new columns to the summed ones. The rows are range-sorted once and written to the shared
    folder with their index, so that later steps see one fixed order. Rows equal in ``order`` are told
    apart by their input position, so a value that a third of the rows share is spread over partitions.
    The only table that one task sees whole has one row per partition.
    """
    from scenlens.sources.shared import staged

    spark, sums = df.sparkSession, sums or {}
    tie, row, part = "__tie", "__row", "__part"
    keys = [*order, tie]
    ranged = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(row, F.monotonically_increasing_id())
        .drop(tie)
    )
    rows = staged(ranged, "numbered").withColumn(part, F.shiftright(row, _ROW_BITS))
    totals = rows.groupBy(part).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__sum_{a}") for a, c in sums.items()]
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        part,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
        *[F.coalesce(F.sum(f"__sum_{a}").over(before), F.lit(0)).alias(f"__base_{a}") for a in sums],
    )
    out = rows.join(F.broadcast(bases), part)  # one row per partition
    index = F.col(row).bitwiseAND((1 << _ROW_BITS) - 1)
    inside = Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__base") + index).alias("position"),
        *[
            (F.col(f"__base_{a}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(a)
            for a, c in sums.items()
        ],
    )
