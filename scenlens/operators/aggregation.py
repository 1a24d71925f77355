"""Grouped aggregates, shares and calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from scenlens.functions import aggregates as A
from scenlens.operators.joins import left_join, strict_left_join
from scenlens.sources.shared import staged


def sum_by(df: DataFrame, keys: Sequence[str], *cols: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[A.sum_strict(c).alias(c) for c in cols])


def mean_by(df: DataFrame, keys: Sequence[str], *cols: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[A.mean_strict(c).alias(c) for c in cols])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in exclude
    ]


def sum_numeric_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum every numeric column that is not a key."""
    return sum_by(df, keys, *numeric_columns(df, keys))


def weighted_ratio(df: DataFrame, keys, value: str, weights: dict[str, str]) -> DataFrame:
    """Weighted means of ``value`` under several weightings in one pass; ``weights``: output -> weight."""
    return df.groupBy(*keys).agg(
        *[A.weighted_mean_of(value, w).alias(out) for out, w in weights.items()]
    )


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str, out: str, null_keys: bool = False
) -> DataFrame:
    """Each row's share of its group's total.

    Written as an aggregate joined back rather than as a window: the totals are combined map-side and
    hold one row per group, so a group with a third of all rows never has to sit in one task. ``df`` is
    read twice; stage it if it is costly.
    """
    totals = df.groupBy(*keys).agg(A.sum_strict(value).alias("__total"))
    joined = left_join(df, totals, keys, null_keys, spread=True)
    return joined.withColumn(out, F.try_divide(F.col(value), F.col("__total"))).drop("__total")


def calibrate(
    df: DataFrame,
    observed: DataFrame,
    keys: Sequence[str],
    observed_on: Sequence[str],
    value: str,
    observed_value: str,
    ref_year: int,
    out: str,
    factor: str,
) -> DataFrame:
    """Rescale ``value`` in all years so that its mean in ``ref_year`` meets the observed one.

    Groups without rows in ``ref_year`` fail, as do groups without an observation. ``df`` is written once,
    as it is read twice. A group's rows may be many, so they are joined to the factors spread.
    """
    df = staged(df, "calibrated")
    modelled = (
        df.filter(F.col("year") == ref_year)
        .groupBy(*keys)
        .agg(A.mean_strict(value).alias("__modelled"))
    )
    factors = strict_left_join(
        modelled, observed.select(*observed_on, observed_value), observed_on
    ).select(*keys, F.try_divide(F.col(observed_value), F.col("__modelled")).alias(factor))
    return strict_left_join(df, factors, keys, spread=True).withColumn(out, F.col(factor) * F.col(value))
