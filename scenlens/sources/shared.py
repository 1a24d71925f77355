"""The folder that all executors share, for results that are read more than once."""

from __future__ import annotations

import re
import tempfile
import uuid

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_local_default: dict[str, str] = {}
_scopes: dict[str, list[str]] = {}  # folders that were made while a scope was open
_open: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, a temporary folder serves a session that says it runs in one local process; any
    other session fails.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _local_default:
        _local_default["dir"] = tempfile.mkdtemp(prefix="scenlens-")
    return _local_default["dir"]


def delete_staged(spark: SparkSession) -> None:
    """Delete all that this package staged in the shared folder; for the end of a job, as nothing can be read after."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/scenlens")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{shared_dir(spark)}/scenlens/{uuid.uuid4().hex}"
    for name in _open:
        _scopes[name].append(folder)
    return f"{folder}/{label}"


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Folders made inside belong to the scope ``name``, until ``delete_scope`` empties it."""
    _scopes.setdefault(name, [])
    _open.append(name)
    try:
        yield
    finally:
        _open.remove(name)


def delete_scope(spark: SparkSession, name: str, but_for: Sequence[DataFrame] = ()) -> int:
    """Delete the folders of a scope, but for those that the plans of ``but_for`` read; returns how many went.

    Any other DataFrame that reads from them can't be computed after this.
    """
    read = [root for df in but_for for root in roots_of(df)]
    kept, n = [], 0
    for folder in _scopes.get(name, []):
        if any(folder.rsplit("/", 1)[-1] in root for root in read):
            kept.append(folder)
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    _scopes[name] = kept
    return n


def roots_of(df: DataFrame) -> list[str]:
    """The folders and files that the plan of ``df`` names as its file sources."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            out += [roots.apply(j).toString() for j in range(roots.size())]
    return out


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For an aggregate that several branches of a plan use: it is computed once, its lineage ends at files
    that survive the loss of an executor, and the reader knows its true size when it picks a join.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """A small lookup written into the plan itself, so Spark knows its size and broadcasts it unasked."""
    fields = StructType.fromDDL(ddl).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
