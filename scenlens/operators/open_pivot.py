"""Pivots whose members come from the data.

A pivot to columns needs its members before it is planned: from a list, or from a job that collects them. Here
a row's cells stay one column, a map from member to value, so the schema is the same whatever members occur
and nothing is planned twice. ``widened`` turns listed members into columns; ``members`` says which there are.

The number of members is bounded: a map is one value of one row. It is checked before any map is made, by
counting the distinct members, and a job with more fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scenlens.functions.aggregates import single
from scenlens.operators.joins import left_join

CELLS = "cells"
MOST_MEMBERS = 10_000


def members(df: DataFrame, name: str | Sequence[str]) -> DataFrame:
    """(member) of all rows, once each."""
    return df.select(_member(name).alias("member")).distinct()


def _member(name: str | Sequence[str]) -> Column:
    """A column's text, or the texts of several joined by underscores; null if one is."""
    names = [name] if isinstance(name, str) else list(name)
    texts = [F.col(f"`{n}`").cast("string") for n in names]
    whole = F.lit(True)
    for t in texts:
        whole = whole & t.isNotNull()
    return F.when(whole, F.concat_ws("_", *texts))


def pivot_open(
    df: DataFrame, ids: Sequence[str], name: str | Sequence[str], value: str, most: int = MOST_MEMBERS, fill: object = None
) -> DataFrame:
    """One row per ``ids`` with a map ``cells`` from every member that occurs there to its value.

    A second value for one cell fails the job, as does a null member, and more than ``most`` members in all.
    With ``fill`` every row's map has all members, which a job finds first, those that it lacks with that value.
    ``df`` is read twice, so stage it if it is costly. A group is one row per member, so none is larger than
    ``most``.
    """
    ids = list(ids)
    clash = {CELLS, "__member"} & set(ids)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    member = _member(name)
    named = F.when(member.isNotNull(), member).otherwise(F.raise_error(F.lit("a cell without a member")))
    cells = df.select(*[F.col(f"`{i}`") for i in ids], named.alias("__member"), F.col(f"`{value}`").alias("__value"))
    n = members(df, name).agg(F.count(F.lit(1)).alias("n")).scalar()
    message = F.concat(F.lit(f"more than {most} members: "), n.cast("string"))
    few = F.when(n > most, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    once = cells.filter(few).groupBy(*ids, "__member").agg(single("__value").alias("__value"))
    found = once.groupBy(*ids).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__member", "__value")))).alias(CELLS))
    if fill is None:
        return found
    names = sorted(r.member for r in members(df, name).filter("member is not null").limit(most + 1).collect())  # bounded
    every = F.array(*[F.lit(m) for m in names]).cast("array<string>")
    kind = dict(df.dtypes)[value]
    filled = F.map_from_arrays(every, F.transform(every, lambda m: F.coalesce(F.try_element_at(CELLS, m), F.lit(fill).cast(kind))))
    return found.withColumn(CELLS, filled)


def widened(pivoted: DataFrame, wanted: Sequence[str], other: str = "drop") -> DataFrame:
    """The cells of listed members as columns; members that aren't listed are dropped, or kept in ``cells``."""
    if other not in ("drop", "keep"):
        raise ValueError(f"other is drop or keep, not {other!r}")
    ids = [F.col(f"`{c}`") for c in pivoted.columns if c != CELLS]
    columns = [F.try_element_at(CELLS, F.lit(m)).alias(m) for m in wanted]
    rest = [F.map_filter(CELLS, lambda k, _: ~k.isin(*wanted)).alias(CELLS)] if other == "keep" else []
    return pivoted.select(*ids, *columns, *rest)


def long_cells(pivoted: DataFrame, name: str, value: str) -> DataFrame:
    """A pivot back to one row per cell."""
    ids = [F.col(f"`{c}`") for c in pivoted.columns if c != CELLS]
    return pivoted.select(*ids, F.explode(CELLS).alias(name, value))


def join_pivots(left: DataFrame, right: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Two pivots by their ids as one; a member of both takes its value from the right one."""
    other = right.withColumnRenamed(CELLS, "__right")
    joined = left_join(left, other, list(ids), null_keys=True, spread=True)
    kept = F.map_filter(CELLS, lambda k, _: ~F.coalesce(F.map_contains_key("__right", k), F.lit(False)))
    empty = F.map_filter(CELLS, lambda k, v: F.lit(False))
    return joined.withColumn(CELLS, F.map_concat(kept, F.coalesce("__right", empty))).drop("__right")
