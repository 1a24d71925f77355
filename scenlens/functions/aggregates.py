"""Aggregate columns in which one missing value makes the whole group missing.

Spark's own ``sum`` and ``avg`` skip nulls. The indicator definitions do not: a region with an unknown
value must not look like a region with a smaller one. All of these are built from ``sum`` and ``count``,
so they keep Spark's map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _complete(*cols: Column) -> Column:
    """True when no row of the group has a null in any of ``cols``."""
    every = F.lit(True)
    for c in cols:
        every = every & (F.count(c) == F.count(F.lit(1)))
    return every


def sum_strict(c: str | Column) -> Column:
    c = _col(c)
    return F.when(_complete(c), F.sum(c))


def mean_strict(c: str | Column) -> Column:
    c = _col(c)
    return F.when(_complete(c), F.avg(c))


def median_strict(c: str | Column) -> Column:
    """Exact median; for groups with few rows, as it is not combined map-side."""
    c = _col(c)
    return F.when(_complete(c), F.median(c))


def weighted_sum_of(value: str | Column, weight: str | Column) -> Column:
    """Sum of value x weight, null if either is missing anywhere in the group."""
    return sum_strict(_col(value) * _col(weight))


def weighted_mean_of(value: str | Column, weight: str | Column) -> Column:
    """Sum of value x weight over sum of weight; null for a zero denominator."""
    return F.try_divide(weighted_sum_of(value, weight), sum_strict(weight))


def ratio_of_sums_of(num: str | Column, den: str | Column) -> Column:
    return F.try_divide(sum_strict(num), sum_strict(den))


def single(c: str | Column, when: Column | None = None, what: str = "cell") -> Column:
    """The one value of ``c`` in the group (among rows where ``when`` holds); fails on a second row."""
    c = _col(c)
    if when is None:
        return F.when(
            F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"more than one row for one {what}"))
        ).otherwise(F.max(c))
    return F.when(
        F.count_if(when) > 1, F.raise_error(F.lit(f"more than one row for one {what}"))
    ).otherwise(F.max(F.when(when, c)))
