"""Joins with explicit keys.

No join here carries an unconditional ``broadcast`` hint: Spark broadcasts a side whose size it knows to
be under ``spark.sql.autoBroadcastJoinThreshold`` (from file statistics, or at run time from the shuffled
bytes) and otherwise sort-merges, where adaptive execution splits skewed partitions. The only hinted
sides are those whose row count the caller can prove, see ``attach_baseline``.

Adaptive execution only splits a hot key if both sides of the join come straight out of a shuffle of
their own. A right side that was just grouped by the same key does not: Spark reuses that grouping, and
all left rows of a hot key then meet in one task. Such joins are ``spread``: a hash of the key joins
along as a second key. The grouping no longer fits, the grouped rows (one per key) are shuffled once
more, and a hot key can be split again. The output is unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_MATCH = "__matched"
_SPREAD = "__spread"


def _as_list(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _check_names(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in on if k not in df.columns]
        if missing:
            raise ValueError(f"join keys {missing} are not columns of the {side} side")
    clash = sorted((set(left.columns) & set(right.columns)) - set(on))
    if clash:
        raise ValueError(f"columns {clash} exist on both sides; rename them or make them keys")


def _join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, null_keys: bool, spread: bool = False
) -> DataFrame:
    _check_names(left, right, on)
    values = [] if how == "left_anti" else [c for c in right.columns if c not in on]
    out = [*_quoted(left.columns), *_quoted(values)]
    if spread:
        left = left.withColumn(_SPREAD, F.xxhash64(*_quoted(on)))
        right = right.withColumn(_SPREAD, F.xxhash64(*_quoted(on)))
        on = [*on, _SPREAD]
    if not null_keys:
        return left.join(right, on, how).select(*out)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in on})
    cond = None
    for k in on:
        eq = left[f"`{k}`"].eqNullSafe(renamed[f"`__r_{k}`"])
        cond = eq if cond is None else cond & eq
    return left.join(renamed, cond, how).select(*out)


def left_join(
    left: DataFrame, right: DataFrame, on, null_keys: bool = False, spread: bool = False
) -> DataFrame:
    """Left join on named keys. ``null_keys`` makes a null key match a null key.

    Set ``spread`` where ``right`` is grouped by the same keys and the left side may have hot ones.
    """
    return _join(left, right, _as_list(on), "left", null_keys, spread)


def inner_join(left: DataFrame, right: DataFrame, on, null_keys: bool = False) -> DataFrame:
    return _join(left, right, _as_list(on), "inner", null_keys)


def full_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    on = _as_list(on)
    _check_names(left, right, on)
    return left.join(right, on, "full")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows whose key does not occur on the right. The right keys are made distinct first."""
    on = _as_list(on)
    return _join(left, right.select(*_quoted(on)).distinct(), on, "left_anti", False, spread=True)


def shared_names(left: DataFrame, right: DataFrame) -> list[str]:
    """The keys of a natural join: columns of both sides, in left order."""
    both = [c for c in left.columns if c in right.columns]
    if not both:
        raise ValueError("natural join without shared columns would be a cross join")
    return both


def natural_left_join(left: DataFrame, right: DataFrame, null_keys: bool = False) -> DataFrame:
    return left_join(left, right, shared_names(left, right), null_keys)


def natural_inner_join(left: DataFrame, right: DataFrame, null_keys: bool = False) -> DataFrame:
    return inner_join(left, right, shared_names(left, right), null_keys)


def unique_rows(df: DataFrame, on) -> DataFrame:
    """``df`` itself, but the job fails if two rows share a key. The check is a group-by on the key."""
    on = _as_list(on)
    rest = [c for c in df.columns if c not in on]
    tag = "__n"
    grouped = df.groupBy(*_quoted(on)).agg(
        F.count(F.lit(1)).alias(tag), *[F.first(f"`{c}`").alias(c) for c in rest]
    )
    key_text = F.to_json(F.struct(*_quoted(on)))
    once = F.when(
        F.col(tag) > 1, F.raise_error(F.concat(F.lit("more than one row for key "), key_text))
    ).otherwise(F.lit(True))
    return grouped.filter(once).select(*_quoted(df.columns))


def strict_left_join(
    left: DataFrame, right: DataFrame, on, null_keys: bool = False, reject_null: bool = False,
    spread: bool = False,
) -> DataFrame:
    """Left join in which every left row must match exactly one right row; the job fails otherwise.

    ``reject_null`` also fails when a matched row brings a null value. The plan stays lazy: the failure
    is raised by the tasks that meet the offending row. The check that right keys are unique shuffles the
    right side by the key, and the join uses that same shuffle; set ``spread`` where the left side may have
    hot keys, which shuffles the checked rows once more so that a hot key can be split.
    """
    on = _as_list(on)
    values = [c for c in right.columns if c not in on]
    checked = unique_rows(right, on).withColumn(_MATCH, F.lit(True))
    joined = _join(left, checked, on, "left", null_keys, spread)
    bad = F.col(_MATCH).isNull()
    if reject_null:
        for c in _quoted(values):
            bad = bad | c.isNull()
    text = F.concat(F.lit("no match for "), F.to_json(F.struct(*_quoted(on))))
    return joined.filter(F.when(bad, F.raise_error(text)).otherwise(F.lit(True))).drop(_MATCH)


def attach_baseline(
    df: DataFrame,
    is_base: Column,
    on,
    measures: Sequence[str],
    suffix: str = "_base",
    bounded: bool = False,
) -> DataFrame:
    """Add the baseline rows' measures to every row with the same ``on`` keys.

    Every row needs exactly one baseline row. Set ``bounded`` only where the keys themselves bound the
    baseline (say, years inside a fixed window): the unique baseline rows are then broadcast, and a
    report with few distinct years is not squeezed through as few join tasks.
    """
    on = _as_list(on)
    base = df.filter(is_base).select(
        *_quoted(on), *[F.col(f"`{m}`").alias(f"{m}{suffix}") for m in measures]
    )
    if bounded:
        base = F.broadcast(unique_rows(base, on))
        base = base.withColumn(_MATCH, F.lit(True))
        text = F.concat(F.lit("no baseline for "), F.to_json(F.struct(*_quoted(on))))
        matched = F.when(F.col(_MATCH).isNull(), F.raise_error(text)).otherwise(F.lit(True))
        return _join(df, base, on, "left", False).filter(matched).drop(_MATCH)
    return strict_left_join(df, base, on)


def attach_scalar(df: DataFrame, one_row: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns of a one-row frame to every row, as scalar subqueries.

    ``columns`` maps new name -> column of ``one_row``. A frame with no row or several rows fails.
    """
    n = F.count(F.lit(1))
    for new, old in columns.items():
        value = F.when(
            n != 1, F.raise_error(F.concat(F.lit("expected one row, found "), n.cast("string")))
        ).otherwise(F.max(f"`{old}`"))
        df = df.withColumn(new, one_row.agg(value.alias("v")).scalar())
    return df


def cross_scenarios(df: DataFrame, scenarios: Sequence[str], name: str = "scenario") -> DataFrame:
    """One copy of every row per listed scenario (a generator over a literal list, not a join)."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(s) for s in scenarios])))
