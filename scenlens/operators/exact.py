"""Sums of doubles that do not depend on the order of the rows.

A sum of doubles rounds at every addition, so it changes with partitions and retries. Here every value is cut
into parts that are whole multiples of powers of two, 2^32 apart; the parts of one power are whole numbers, and
these are summed exactly, as two longs each, by native aggregates that combine before the shuffle. A group has
at most 66 such powers. Their sums are carried into the digits of one number, which is rounded once: the result
is the double nearest to the exact sum of the given doubles.

Defined results: a null makes its group's sum null, as everywhere in this library; NaN, or infinities of both
signs, make it NaN, one infinity makes it that. Sums beyond the largest double are infinite; results below
2^-1022 may lose their last digits. Zero is positive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

STEP = 32  # bits between two powers
_LOW, _HIGH = -33, 31  # the powers 2^(STEP * j) that doubles have
_HALF = 16


def _power(j: Column) -> Column:
    """2^(STEP * j) as a double; exact."""
    return F.get(F.array(*[F.lit(2.0 ** (STEP * i)) for i in range(_LOW, _HIGH + 1)]), j - _LOW)


def _parts(x: Column) -> Column:
    """Array of (bin, part): x is the sum of part * 2^(STEP * bin); three bins hold the 53 bits of a double."""
    size = F.abs(x)
    top = F.floor(F.log2(size) / STEP + F.lit(1e-9)).cast("int")
    top = F.greatest(top, F.lit(_LOW + 2))

    def cut(rest: Column, j: Column) -> Column:
        return (rest / _power(j)).cast("long")  # towards zero; the quotient is exact

    def left(rest: Column, j: Column) -> Column:
        return rest - cut(rest, j).cast("double") * _power(j)  # exact: what is left of the bits

    one = left(x, top)
    two = left(one, top - 1)
    some = [(top, cut(x, top)), (top - 1, cut(one, top - 1)), (top - 2, cut(two, top - 2))]
    parts = F.array(*[F.struct(j.alias("bin"), c.alias("part")) for j, c in some])
    finite = ~F.isnan(x) & (size < F.lit(float("inf"))) & (x != 0)
    return F.when(finite, parts).otherwise(F.array().cast("array<struct<bin:int,part:bigint>>"))


def exact_sums(df: DataFrame, keys: Sequence[str], *cols: str, counts: bool = False) -> DataFrame:
    """Grouped sums of double columns; the same bits whatever the order and partitions. ``counts`` adds ``n``.

    Rows are cut and combined in their tasks; a bin's sums take 2^46 rows before they could overflow.
    """
    keys = list(keys)
    entries = [F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(cols)]
    each = df.select(*[F.col(f"`{k}`") for k in keys], F.inline(F.array(*entries)))
    odd = F.isnan("x") | (F.abs("x") == F.lit(float("inf")))
    none = F.array().cast("array<struct<bin:int,part:bigint>>")
    mark = F.array(F.struct(F.lit(None).cast("int").alias("bin"), F.lit(0).cast("bigint").alias("part")))  # one for each row
    cut = each.withColumn("cut", F.explode(F.concat(mark, F.coalesce(_parts(F.col("x")), none))))
    low = F.col("cut.part").bitwiseAND((1 << _HALF) - 1)
    bins = cut.groupBy(*keys, "col", F.col("cut.bin").alias("bin")).agg(
        F.sum(F.shiftright("cut.part", _HALF)).alias("high"),
        F.sum(low).alias("low"),
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("cut.bin").isNull() & F.col("x").isNull(), 1)).alias("nulls"),
        F.sum(F.when(F.col("cut.bin").isNull() & odd, F.col("x"))).alias("odd"),
    )
    limb = F.col("high").cast("decimal(38,0)") * F.lit(1 << _HALF).cast("decimal(10,0)") + F.col("low").cast("decimal(38,0)")
    groups = bins.groupBy(*keys, "col").agg(
        F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", limb.cast("decimal(38,0)").alias("limb")))).alias("limbs"),
        F.max(F.when(F.col("bin").isNull(), F.col("n"))).alias("n"),
        F.max("nulls").alias("nulls"),
        F.max(F.when(F.col("bin").isNull(), F.col("odd"))).alias("odd"),
    )
    total = F.when(F.col("nulls") > 0, F.lit(None).cast("double")).when(F.col("odd").isNotNull(), F.col("odd")).otherwise(rounded(F.col("limbs")))
    out = groups.select(*keys, "col", total.alias("total"), "n")
    picked = [F.max(F.when(F.col("col") == i, F.col("total"))).alias(c) for i, c in enumerate(cols)]
    extra = [F.max("n").alias("n")] if counts else []
    return out.groupBy(*keys).agg(*picked, *extra)


_DIGIT = "decimal(38,0)"


def _carried(limbs: Column) -> Column:
    """Whole numbers by rising power to digits below 2^STEP and what is carried out of the last one."""
    base = F.lit(1 << STEP).cast(_DIGIT)
    start = F.struct(F.lit(0).cast(_DIGIT).alias("carry"), F.array().cast(f"array<{_DIGIT}>").alias("digits"))

    def step(acc: Column, limb: Column) -> Column:
        v = (acc["carry"] + limb).cast(_DIGIT)
        digit = F.pmod(v, base).cast(_DIGIT)
        carry = ((v - digit).cast(_DIGIT) / base).cast(_DIGIT)  # divides evenly
        return F.struct(carry.alias("carry"), F.concat(acc["digits"], F.array(digit)).alias("digits"))

    return F.aggregate(limbs, start, step)


def rounded(entries: Column) -> Column:
    """The double nearest to the sum of limb * 2^(STEP * bin) over an array of (bin, limb)."""
    first = F.array_min(F.transform(entries, lambda e: e["bin"]))
    last = F.array_max(F.transform(entries, lambda e: e["bin"]))
    known = F.map_from_entries(entries)
    zero = F.lit(0).cast(_DIGIT)
    limbs = F.transform(F.sequence(first, last + 3), lambda j: F.coalesce(F.try_element_at(known, j), zero))
    up = _carried(limbs)
    negative = up["carry"] < 0
    digits = F.when(negative, _carried(F.transform(limbs, lambda x: (-x).cast(_DIGIT)))["digits"]).otherwise(up["digits"])
    filled = F.filter(F.transform(digits, lambda d, i: F.when(d != 0, i)), lambda i: i.isNotNull())
    top = F.array_max(filled)

    def digit(i: Column) -> Column:
        return F.coalesce(F.get(digits, i), zero)

    base = F.lit(1 << STEP).cast("decimal(11,0)")
    three = ((digit(top) * base + digit(top - 1)).cast(_DIGIT) * base + digit(top - 2)).cast(_DIGIT)
    below = F.array_min(filled) < top - 2  # something is left beyond the three digits: a tie is none
    mantissa = F.when(below, (three * F.lit(2).cast("decimal(1,0)") + F.lit(1).cast("decimal(1,0)")).cast(_DIGIT)).otherwise(three)
    whole = mantissa.cast("string").cast("double") / F.when(below, F.lit(2.0)).otherwise(F.lit(1.0))
    at = first + top - 2  # may lie a few steps outside of the powers: two factors
    inner = F.greatest(F.lit(_LOW), F.least(F.lit(_HIGH - 1), at))
    value = whole * _power(inner) * F.pow(F.lit(2.0 ** STEP), at - inner)
    return F.when(top.isNull(), F.lit(0.0)).otherwise(F.when(negative, -value).otherwise(value))


def exact_means(df: DataFrame, keys: Sequence[str], *cols: str) -> DataFrame:
    """Grouped means: the exact sum, rounded, over the count."""
    keys = list(keys)
    sums = exact_sums(df, keys, *cols, counts=True)
    return sums.select(*keys, *[(F.col(f"`{c}`") / F.col("n")).alias(c) for c in cols])
