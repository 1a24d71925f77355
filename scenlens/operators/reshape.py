"""Long <-> wide, set operations and completion of missing combinations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from scenlens.functions import aggregates as A


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Append rows by column name; columns absent on a side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def unpivot_years(
    df: DataFrame, ids: Sequence[str], prefix: str = "X", value: str = "value"
) -> DataFrame:
    """Columns ``X2010, X2015, ...`` to rows (ids, year, value)."""
    years = [c for c in df.columns if c.startswith(prefix) and c not in ids]
    long = df.unpivot(list(ids), years, "__name", value)
    year = F.regexp_replace("__name", prefix, "").try_cast("int")
    return long.select(*ids, year.alias("year"), value)


_OTHER = "__other"


def _listed(df: DataFrame, names: str) -> DataFrame:
    """Fails on a group with a member that is not listed."""
    message = F.concat(F.lit(f"{names} has a member that is not listed: "), F.col(_OTHER))
    ok = F.when(F.col(_OTHER).isNotNull(), F.raise_error(message)).otherwise(F.lit(True))
    return df.filter(ok).drop(_OTHER)


def _unlisted(names: str, members: Sequence[str | int], other: str) -> list[Column]:
    """The aggregate that :func:`_listed` reads; none if other members may go."""
    if other == "drop":
        return []
    if other != "fail":
        raise ValueError(f"unknown choice for other members: {other!r}")
    name = F.col(names)
    test = F.when(~F.coalesce(name.isin(*members), F.lit(False)), F.coalesce(name.cast("string"), F.lit("null")))
    return [F.max(test).alias(_OTHER)]


def pivot_members(
    df: DataFrame, ids: Sequence[str], names: str, values: str, members: Sequence[str | int], other: str = "fail"
) -> DataFrame:
    """One column per listed member. Fails if a cell would hold two rows.

    A row whose member is not listed fails the job too; ``other="drop"`` leaves such rows out.

    The member list is explicit, so the schema does not depend on the data and no extra job reads the
    distinct values. One group-by with conditional aggregates: one shuffle, combined map-side.
    """
    unlisted = _unlisted(names, members, other)
    wide = df.groupBy(*ids).agg(
        *[A.single(values, F.col(names) == m, f"{names}={m}").alias(str(m)) for m in members], *unlisted
    )
    return _listed(wide, names) if unlisted else wide


def pivot_years(
    df: DataFrame, ids: Sequence[str], years: Sequence[int], value: str = "value", other: str = "fail"
) -> DataFrame:
    return pivot_members(df, ids, "year", value, years, other)


_WORD = 62  # members that one mask holds


def member_masks(names: str, members: Sequence[str]) -> list[tuple[Column, int]]:
    """For each 62 members: a column with one bit for the row's member, and the mask of all of them."""
    out = []
    for lo in range(0, len(members), _WORD):
        some = members[lo : lo + _WORD]
        bit = F.lit(None).cast("long")
        for i, m in enumerate(some):
            bit = F.when(F.col(names) == m, F.lit(1 << i).cast("long")).otherwise(bit)
        out.append((bit, (1 << len(some)) - 1))
    return out


def all_members(masks: list[tuple[Column, int]], prefix: str) -> Column:
    """True for a group whose aggregated masks ``<prefix>0, <prefix>1, ...`` are full."""
    return reduce(lambda a, b: a & b, [F.col(f"{prefix}{i}") == full for i, (_, full) in enumerate(masks)])


def pivot_complete(
    df: DataFrame, ids: Sequence[str], names: str, values: str, members: Sequence[str], other: str = "fail"
) -> DataFrame:
    """Pivot that keeps only the ids with a value for every member.

    This is what a chain of inner joins, one per member, would return, for one shuffle in place of one
    per member.
    """
    wide = pivot_members(df, ids, names, values, members, other)
    return wide.dropna("any", subset=[str(m) for m in members])


def merge_all_groups(
    df: DataFrame, ids: Sequence[str], group: str, groups: Sequence[str], names: str, values: str,
    members: Sequence[str], other: str = "fail",
) -> DataFrame:
    """Pivot (ids x member), keeping the ids that occur in every one of ``groups``."""
    masks = member_masks(group, groups)
    found = [F.bit_or(bit).alias(f"__groups{i}") for i, (bit, _) in enumerate(masks)]
    unlisted = _unlisted(names, members, other)
    cells = [A.single(values, F.col(names) == m, f"{names}={m}").alias(m) for m in members]
    wide = df.groupBy(*ids).agg(*found, *cells, *unlisted)
    wide = _listed(wide, names) if unlisted else wide
    return wide.filter(all_members(masks, "__groups")).drop(*[f"__groups{i}" for i in range(len(masks))])


def two_period(
    df: DataFrame, keys: Sequence[str], y0: int, y1: int, cols: Sequence[str]
) -> DataFrame:
    """Side-by-side frame of two years (``<col>_0``, ``<col>_1``) for the keys present in both."""
    is0, is1 = F.col("year") == y0, F.col("year") == y1
    cells = [
        A.single(c, cond, f"year {y}").alias(f"{c}_{i}")
        for i, (cond, y) in enumerate(((is0, y0), (is1, y1)))
        for c in cols
    ]
    both = df.filter(is0 | is1).groupBy(*keys).agg(
        F.bool_or(is0).alias("__has0"), F.bool_or(is1).alias("__has1"), *cells
    )
    return both.filter(F.col("__has0") & F.col("__has1")).drop("__has0", "__has1")


def complete(
    df: DataFrame, nesting: Sequence[str], years: Sequence[int], fill: dict[str, float]
) -> DataFrame:
    """Add a row for every observed ``nesting`` combination and listed year that has none.

    Added rows take ``fill`` values and so do nulls of existing rows; rows of other years stay. The
    missing years of a combination come from one flag per listed year, so the only shuffle is that of
    the combinations, combined map-side. ``df`` is read twice; stage it if it is costly.
    """
    flags = [F.bool_or(F.col("year") == y).alias(f"__y{y}") for y in years]
    absent = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.col(f"__y{y}"), F.lit(False)), F.lit(y)) for y in years])
    )
    absent = absent.cast(ArrayType(df.schema["year"].dataType))
    added = df.groupBy(*nesting).agg(*flags).select(*nesting, F.explode(absent).alias("year"))
    both = union_by_name(df, added)
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def fold_member(
    df: DataFrame, col: str, frm: str, to: str, keys: Sequence[str], value: str
) -> DataFrame:
    """Count the rows of member ``frm`` under ``to`` and sum."""
    moved = df.withColumn(col, F.when(F.col(col) == frm, F.lit(to)).otherwise(F.col(col)))
    return moved.groupBy(*keys).agg(A.sum_strict(value).alias(value))


def duplicate_member(df: DataFrame, cond: Column, **overrides) -> DataFrame:
    """Append a copy of the rows matching ``cond`` with some columns set to constants."""
    copies = df.filter(cond).withColumns(
        {c: F.lit(v).cast(df.schema[c].dataType) for c, v in overrides.items()}
    )
    return df.unionByName(copies)
