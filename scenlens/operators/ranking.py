"""Places of rows in a global order, without a task that sees all rows.

``orderBy`` gives an order but no numbers, and a window without partition keys gives numbers in one task.
Here the rows are range-sorted and written with their index in their partition; a place is that index plus
the number of rows in the partitions before. The only table that one task sees whole has one row for each
partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scenlens.operators.joins import left_join
from scenlens.sources.shared import staged

_INDEX_BITS = 33  # of monotonically_increasing_id(): the row's index in its partition


def _names(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def placed(
    df: DataFrame, order: Sequence[Column | str], place: str = "place", running: Mapping[str, str] | None = None
) -> DataFrame:
    """Add each row's 0-based place in ``order``, and for each name in ``running`` the sum of its column before the row.

    Rows that are equal in the order keep the places of their input rows, so they are told apart and a value
    that a third of all rows share is spread over partitions. The input is written first: the order of rows
    that a shuffle delivers can change when a task is run again, and a place must not. Sums skip nulls.
    """
    spark, running = df.sparkSession, dict(running or {})
    clash = {place, *running} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    tie, row, part = "__tie", "__row", "__part"
    keys = [*(F.col(f"`{c}`") if isinstance(c, str) else c for c in order), F.col(tie)]
    given = staged(df, "unordered").withColumn(tie, F.monotonically_increasing_id())
    ranged = given.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(row, F.monotonically_increasing_id()).drop(tie)
    rows = staged(ranged, "ordered").withColumn(part, F.shiftright(row, _INDEX_BITS))
    sums = {out: F.coalesce(F.sum(f"`{c}`"), F.lit(0)) for out, c in running.items()}
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("__n"), *[s.alias(f"__sum_{i}") for i, s in enumerate(sums.values())])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = counts.select(
        part,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
        *[F.coalesce(F.sum(f"__sum_{i}").over(before), F.lit(0)).alias(f"__base_{i}") for i in range(len(running))],
    )
    index = F.col(row).bitwiseAND((1 << _INDEX_BITS) - 1)
    inside = Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(F.broadcast(bases), part).select(  # one row per partition
        *_names(df),
        (F.col("__base") + index).alias(place),
        *[
            (F.col(f"__base_{i}") + F.coalesce(F.sum(f"`{c}`").over(inside), F.lit(0))).alias(out)
            for i, (out, c) in enumerate(running.items())
        ],
    )


def ranked(df: DataFrame, order: Sequence[Column | str], by: Sequence[str], rank: str = "rank", dense: bool = False) -> DataFrame:
    """Add the 1-based rank in ``order``, in which rows with equal ``by`` columns share the rank of the first of them.

    ``by`` are the columns that the order goes by. ``dense`` ranks leave no gaps. The values of ``by`` are
    few or many: they are combined map-side and joined back.
    """
    by = list(by)
    rows = staged(placed(df, order, "__place"), "placed")
    values = rows.groupBy(*[f"`{c}`" for c in by]).agg(F.min("__place").alias("__first"))
    if dense:
        values = placed(values, ["__first"], "__number").select(*by, (F.col("__number") + 1).alias(rank))
    else:
        values = values.select(*by, (F.col("__first") + 1).alias(rank))
    return left_join(rows, values, by, null_keys=True, spread=True).select(*_names(df), rank)


def numeric_order(*cols: str) -> list[Column]:
    """The order of text columns by their numeric reading, unreadable values last."""
    return [F.col(f"`{c}`").try_cast("double").asc_nulls_last() for c in cols]
