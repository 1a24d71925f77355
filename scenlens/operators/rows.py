"""Row filters, column selection and value repairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scenlens.operators.aggregation import numeric_columns
from scenlens.operators.ranking import numeric_order


def scale(df: DataFrame, col: str, factor: float) -> DataFrame:
    return df.withColumn(col, F.col(col) * F.lit(float(factor)))


def between_years(df: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Rows with lo <= year <= hi; either end may be open."""
    if lo is not None:
        df = df.filter(F.col("year") >= lo)
    if hi is not None:
        df = df.filter(F.col("year") <= hi)
    return df


def isin_years(df: DataFrame, years: Sequence[int]) -> DataFrame:
    return df.filter(F.col("year").isin(*years))


def match_rows(df: DataFrame, col: str, regex: str, negate: bool = False) -> DataFrame:
    """Rows whose text matches ``regex`` anywhere (or does not, with ``negate``). A null matches nothing."""
    hit = F.coalesce(F.col(col).rlike(regex), F.lit(False))
    return df.filter(~hit if negate else hit)


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(cols) if cols else None)


def patch_value(df: DataFrame, col: str, cond: Column, value: Column) -> DataFrame:
    return df.withColumn(col, F.when(cond, value).otherwise(F.col(col)))


def zero_fill(df: DataFrame, except_cols: Sequence[str]) -> DataFrame:
    cols = numeric_columns(df, except_cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def map_numeric(
    df: DataFrame, fn: Callable[[Column], Column], exclude: Sequence[str] = ()
) -> DataFrame:
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in numeric_columns(df, exclude)})


def cols_matching(df: DataFrame, predicate: Callable[[str], bool]) -> list[str]:
    return [c for c in df.columns if predicate(c)]


def order_report(df: DataFrame, ids: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    """Identifiers first, then the columns of each prefix in turn; other columns are left out."""
    picked = [c for p in prefixes for c in df.columns if c.startswith(p)]
    return df.select(*ids, *picked)


def sort_numeric(df: DataFrame, *cols: str) -> DataFrame:
    """Sort by the numeric reading of text columns, unreadable values last. For final outputs only."""
    return df.orderBy(*numeric_order(*cols))


def sort_report(df: DataFrame, group: str, number: str) -> DataFrame:
    return df.orderBy(*report_order(group, number))


def report_order(group: str, number: str) -> list[Column]:
    """The order of a report: by group, then by the numeric reading of a level."""
    return [F.col(group).asc_nulls_last(), *numeric_order(number)]


def strip_prefix(df: DataFrame) -> DataFrame:
    """Keep what follows the last dot of every column name."""
    names = [c.rsplit(".", 1)[-1] for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"stripping prefixes makes column names ambiguous: {names}")
    return df.toDF(*names)
