"""Many CSV files as one table, bound by column name and read once.

Spark binds CSV columns by position. Files with other columns, or the same ones in another order, therefore
need their headers first. Here a table of the files is made from the listing alone, and a task reads of each
file only the bytes up to its first line break. All files are then read by one scan, whatever their headers
are, as texts by position; the header, joined by the file's path, says which position a column has.

Paths stay in tables: no list of them reaches the driver's Python. Names select files in the listing itself,
as Spark prunes files by predicates on their metadata.

The header's bytes are read in place where the store is one of ``RANGED``; for another store one scan of the
files as text finds their first lines.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scenlens.sources.shared import staged
from scenlens.sources.shipping import ship

RANGED = ("file", "hdfs")
CHUNK = 4096

_HEADER = "path string, names array<string>"
_CORRUPT = "__line"


# Files


def file_table(spark: SparkSession, sources: str | Sequence[str], include: str = "", exclude: str | None = None) -> DataFrame:
    """(path, name, size) of the files of a folder, or of files, by their names; nothing of them is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.load(sources if isinstance(sources, str) else list(sources))
    named = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("length").alias("size"))
    return named.filter(selected(F.col("name"), include, exclude))


def selected(name: Column, include: str, exclude: str | None) -> Column:
    """Whether a regex finds something in a name, and another one nothing."""
    found = name.rlike(include) if include else F.lit(True)
    return found & ~name.rlike(exclude) if exclude else found


def empty_files(spark: SparkSession, folder: str, include: str = "", exclude: str | None = None) -> DataFrame:
    """(path, name) of the files without bytes, which Spark's own listing leaves out; none where the store isn't RANGED."""
    if _store_of(spark, folder) not in RANGED:
        return spark.createDataFrame([], "path string, name string")
    ship(spark)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for _ in batches:
            store, inner = _store(root)
            for info in store.get_file_info(fs.FileSelector(inner, recursive=True)):
                if info.is_file and info.size == 0 and not info.base_name.startswith((".", "_")):
                    yield pa.RecordBatch.from_pydict({"path": [info.path], "name": [info.base_name]})

    found = spark.range(0, 1, 1, 1).mapInArrow(listed, "path string, name string")
    return found.filter(selected(F.col("name"), include, exclude))


# Headers


def header_of(read: Callable[[int, int], bytes], size: int) -> list[str]:
    """Column names in the first line of a file, from a function that reads (offset, length)."""
    data = b""
    while len(data) < size and b"\n" not in data:
        data += read(len(data), min(CHUNK, size - len(data)))
    line = data.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")
    return next(csv.reader([line]), [])


def _store(path: str):
    """Arrow's store of a path as Spark writes it, and the path in it."""
    from pyarrow import fs

    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    """A file by the path of its metadata, in which odd characters are escaped."""
    store, inner = _store(path)
    return store.open_input_file(unquote(inner))


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, names = batch.column("path").to_pylist(), []
        for path, size in zip(paths, batch.column("size").to_pylist(), strict=True):
            with _open(path) as f:

                def read(at: int, n: int) -> bytes:
                    f.seek(at)
                    return f.read(n)

                names.append(header_of(read, size))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(names, pa.list_(pa.string()))], ["path", "names"])


def headers(files: DataFrame, sources: str | Sequence[str], ranged: bool) -> DataFrame:
    """(path, names) of the files, which ``sources`` hold; written."""
    spark = files.sparkSession
    if ranged:
        ship(spark)
        return staged(files.select("path", "size").mapInArrow(_headers, _HEADER), "headers")
    lines = spark.read.option("recursiveFileLookup", True).text(sources if isinstance(sources, str) else list(sources)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"), "value",
    )
    wanted = lines.filter(F.col("start") == 0).join(files.select("path"), "path", "left_semi")
    first = wanted.groupBy("path").agg(F.min_by("value", "n").alias("line"))
    bare = F.regexp_replace("line", "[\r﻿]", "")
    cells = F.transform(F.split(bare, r',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda c: F.regexp_replace(c, '^"|"$', ""))
    return staged(first.select("path", cells.alias("names")), "headers")


# Rows


def _store_of(spark: SparkSession, source: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()


def empty_table(spark: SparkSession, schema: StructType, with_file: bool = False) -> DataFrame:
    extra = [StructField("file", StringType())] if with_file else []
    return spark.createDataFrame([], StructType(schema.fields + extra))


def read_by_name(
    spark: SparkSession,
    sources: str | Sequence[str],
    schema: StructType,
    include: str = "",
    exclude: str | None = None,
    with_file: bool = False,
    files: DataFrame | None = None,
) -> DataFrame:
    """The rows of the CSV files in a folder (or of a few named files), bound to ``schema`` by column name.

    Columns a file lacks become null, columns outside the schema are left out, and of columns with one name
    the first is taken. ``NA`` and empty fields are null. A field that doesn't read as its type and a row
    with more or fewer fields than its file's header fail the job. Files of no bytes have no rows.
    """
    if files is None:
        files = staged(file_table(spark, sources, include, exclude), "files")
    filled = files.filter("size > 0")
    known = headers(filled, sources, _store_of(spark, sources if isinstance(sources, str) else sources[0]) in RANGED)
    width = known.agg(F.max(F.size("names"))).first()[0]
    if not width:
        return empty_table(spark, schema, with_file)
    positions = [f"__c{i}" for i in range(width)]
    texts = StructType([StructField(c, StringType()) for c in [*positions, _CORRUPT]])
    reader = spark.read.option("recursiveFileLookup", True).option("columnPruning", False)
    rows = reader.csv(
        sources if isinstance(sources, str) else list(sources), schema=texts, header=True, nullValue="NA",
        mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT,
    )
    placed = rows.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("__name"), F.array(*positions).alias("__cells"), _CORRUPT
    )
    placed = placed.filter(selected(F.col("__name"), include, exclude)).drop("__name")
    bound = placed.join(known, "path")
    bare = F.regexp_replace(_CORRUPT, '"[^"]*"', "")
    fields = F.when(F.col(_CORRUPT).isNull(), F.lit(width)).otherwise(F.size(F.split(bare, ",", -1)))
    ragged = F.concat(F.lit("MALFORMED row of "), fields.cast("string"), F.lit(" fields in "), F.col("path"))
    whole = F.when(fields == F.size("names"), F.lit(True)).otherwise(F.raise_error(ragged).cast("boolean"))
    columns = []
    for f in schema.fields:
        cell = F.get("__cells", (F.array_position("names", F.lit(f.name)) - 1).cast("int"))
        if not isinstance(f.dataType, StringType):
            value = cell.try_cast(f.dataType)
            message = F.concat(F.lit(f"MALFORMED {f.name}: "), cell, F.lit(" in "), F.col("path"))
            cell = F.when(cell.isNull() | value.isNotNull(), value).otherwise(F.raise_error(message).cast(f.dataType))
        columns.append(cell.alias(f.name))
    if with_file:
        columns.append(F.col("path").alias("file"))
    return bound.filter(whole).select(*columns)


def first_name(files: DataFrame) -> str | None:
    """The path of the first non-empty file by name."""
    row = files.filter("size > 0").orderBy("name", "path").select("path").first()
    return row and row.path


def escaped(path: str) -> str:
    """A path of a file table as the readers take it."""
    return unquote(path) if re.match(r"file:", path) else path
