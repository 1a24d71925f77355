"""Text lookups, regex-selected output files and sinks."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scenlens.operators.reshape import union_by_name
from scenlens.sources.shared import staged
from scenlens.sources.text_scan import empty_files, empty_table, escaped, file_table, first_name, read_by_name, selected

# Columns of the lookup files.
FOOD_GROUPS_SCHEMA = "supplysector string, subsector string"
ENERGY_MULTIPLIER_SCHEMA = "region string, energy_mult double, year int"
FOOD_EXPENDITURE_SCHEMA = "region string, av_food_exp double, year int"
BASINS_SCHEMA = (
    "basin_id int, basin_name string, GLU_code string, GLU_name string, "
    "ISO string, ISO_NUM int, country_name string"
)


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with one header line; columns bind by position. Either line ending is read."""
    return spark.read.csv(path, schema=schema, header=True, ignoreTrailingWhiteSpace=True)


def read_preamble_csv(spark: SparkSession, path: str, schema: str, numeric_col: str) -> DataFrame:
    """A CSV with free-text lines above its header.

    Preamble and header are the lines in which no typed column holds a number or ``NA``, so no line needs
    counting and the file may be split. ``numeric_col`` is one of the typed columns, for a check of the
    schema. ``NA`` and empty fields of data rows are null; any other text that does not read fails the job.
    """
    fields = StructType.fromDDL(schema).fields
    typed = [f for f in fields if not isinstance(f.dataType, StringType)]
    if numeric_col not in [f.name for f in typed]:
        raise ValueError(f"{numeric_col} is not a typed column of {schema}")
    texts = StructType([StructField(f.name, StringType()) for f in fields])
    rows = spark.read.csv(path, schema=texts, mode="PERMISSIVE", multiLine=False, ignoreTrailingWhiteSpace=True)
    data = F.lit(False)
    for f in typed:
        c = F.col(f"`{f.name}`")
        data = data | F.coalesce((c == "NA") | c.try_cast("double").isNotNull(), F.lit(False))
    cols = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        if f in typed:
            value = F.when(~c.isin("NA", ""), c)
            unread = value.isNotNull() & value.try_cast(f.dataType).isNull()
            message = F.concat(F.lit(f"{f.name} does not read: "), value)
            c = F.when(unread, F.raise_error(message).cast(f.dataType)).otherwise(value.try_cast(f.dataType))
        cols.append(c.alias(f.name))
    return rows.filter(data).select(*cols)


def _files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a folder, by name; works on any file system Spark can reach."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(
        (s.getPath().toString(), int(s.getLen())) for s in fs.listStatus(path) if s.isFile()
    )


def list_matching(
    spark: SparkSession,
    folder: str,
    include: str = "",
    exclude: str | None = None,
    warn_empty: bool = True,
) -> list[str]:
    """Non-empty files whose name matches ``include`` and not ``exclude``, in name order."""
    found = []
    for path, size in _files(spark, folder):
        name = path.rsplit("/", 1)[-1]
        if not re.search(include, name) or (exclude and re.search(exclude, name)):
            continue
        if size == 0:
            if warn_empty:
                warnings.warn(f"skipping empty file: {path}", stacklevel=2)
            continue
        found.append(path)
    return found


def _warn_empty(spark: SparkSession, folder: str, include: str, exclude: str | None) -> None:
    empty = empty_files(spark, folder, include, exclude).agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).first()
    if empty.n:
        more = f" and {empty.n - 1} more" if empty.n > 1 else ""
        warnings.warn(f"skipping empty file: {empty.path}{more}", stacklevel=3)


def read_csv_by_name(
    spark: SparkSession, paths: Sequence[str], schema: StructType, with_file: bool = False
) -> DataFrame:
    """A few named CSV files bound to ``schema`` by column name; see ``text_scan.read_by_name``."""
    if not paths:
        return empty_table(spark, schema, with_file)
    return read_by_name(spark, list(paths), schema, with_file=with_file)


def scan_matching(
    spark: SparkSession,
    folder: str,
    include: str,
    schema: StructType,
    exclude: str | None = None,
    warn_empty: bool = True,
    with_file: bool = False,
) -> DataFrame:
    """All rows of the CSV files selected by name, in one scan."""
    found = staged(file_table(spark, folder, include, exclude), "files")
    if warn_empty:
        _warn_empty(spark, folder, include, exclude)
    return read_by_name(spark, folder, schema, include, exclude, with_file, found)


def scan_first(spark: SparkSession, folder: str, include: str, schema: StructType) -> DataFrame:
    """The rows of the first matching file by name."""
    path = first_name(file_table(spark, folder, include))
    if path is None:
        raise FileNotFoundError(f"no file matching {include!r} in {folder}")
    return read_by_name(spark, [escaped(path)], schema)


def extract_matching(spark: SparkSession, folder: str, schema: StructType, include: str = "", exclude: str | None = None) -> DataFrame:
    """Rows of the CSV and Parquet files of a folder; other kinds are skipped with a warning."""
    found = staged(file_table(spark, folder, include, exclude), "files")
    _warn_empty(spark, folder, include, exclude)
    other = found.filter(~F.col("name").rlike(r"\.(csv|parquet)$")).agg(F.min("path").alias("path")).first()
    if other.path:
        warnings.warn(f"skipping unsupported file type: {other.path}", stacklevel=2)
    texts = found.filter(F.col("name").endswith(".csv"))
    rows = read_by_name(spark, folder, schema, _both(include, r"\.csv$"), exclude, files=texts)
    if found.filter(F.col("name").endswith(".parquet")).isEmpty():
        return rows
    tables = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)
    kept = tables.filter(selected(F.col("_metadata.file_name"), include, exclude))
    return union_by_name(rows, kept)


def _both(include: str, ending: str) -> str:
    """A regex for what both regexes find."""
    return f"^(?=.*(?:{include}))(?=.*(?:{ending}))" if include else ending


def extract_data(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """Rows of a few named CSV and Parquet files; other kinds are skipped with a warning."""
    texts, tables = [], []
    for p in paths:
        if p.endswith(".csv"):
            texts.append(p)
        elif p.endswith(".parquet"):
            tables.append(p)
        else:
            warnings.warn(f"skipping unsupported file type: {p}", stacklevel=2)
    parts = []
    if texts or not tables:
        parts.append(read_csv_by_name(spark, texts, schema))
    if tables:
        parts.append(spark.read.schema(schema).parquet(*tables))
    return union_by_name(*parts)


def write_indicator(df: DataFrame, root: str, indicator: str, mode: str = "overwrite") -> str:
    """One folder per project under the indicator, as CSV. ``df`` carries a ``project`` column.

    Overwriting replaces the folders of the projects in ``df`` and leaves other projects alone.
    """
    path = f"{root}/{indicator}/indiv_results"
    even = df.hint("rebalance", "project")
    writer = even.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.option("nullValue", "NA").partitionBy("project").csv(path, header=True)
    return path


def read_indicator(
    spark: SparkSession, root: str, indicator: str, schema: StructType, project: str | None = None
) -> DataFrame:
    """Outputs of ``write_indicator``; ``project`` is a regex that prunes project folders."""
    full = StructType(schema.fields + [StructField("project", StringType())])
    df = spark.read.csv(
        f"{root}/{indicator}/indiv_results", schema=full, header=True, nullValue="NA",
        enforceSchema=False,
    )
    return df if project is None else df.filter(F.col("project").rlike(project))


def write_gathered(df: DataFrame, root: str, indicator: str, tag: str) -> tuple[str, str]:
    """The gathered table as Parquet and, read back from it, as CSV."""
    base = f"{root}/{indicator}/{indicator}_{tag}"
    df.write.mode("overwrite").parquet(f"{base}.parquet")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{base}.parquet")
    stored.write.mode("overwrite").option("nullValue", "NA").csv(f"{base}.csv", header=True)
    return f"{base}.parquet", f"{base}.csv"


def write_by_scenario(df: DataFrame, path: str) -> None:
    """One folder per scenario.

    Rebalancing gathers a scenario's rows into few files but lets adaptive execution split a large one,
    which a repartition by scenario would put into a single task.
    """
    even = df.hint("rebalance", "scenario")
    even.write.mode("overwrite").partitionBy("scenario").option("nullValue", "NA").csv(path, header=True)
