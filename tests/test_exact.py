"""Exact sums against ``math.fsum``, which rounds the exact sum once."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from scenlens.operators import exact as E

SCHEMA = "k string, x double, y double"


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else struct.pack("<d", x)


def doubles(rng, n):
    out = []
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            out.append(rng.uniform(-1e6, 1e6))
        elif kind == 1:
            out.append(rng.choice([-1, 1]) * 2.0 ** rng.randrange(-900, 900) * (1 + rng.randrange(2**52) / 2**52))
        elif kind == 2:
            out.append(float(rng.choice([0, -0.0, 1, -1, 2**53, 2**32, -(2**32), 2.0**64, 2.0**-32])))
        elif kind == 3:
            out.append(math.nextafter(2.0 ** (32 * rng.randrange(-20, 20)), rng.choice([0.0, math.inf])))
        else:
            out.append(round(rng.uniform(0, 1e5), 2))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sums_are_exact(spark, seed):
    rng = random.Random(seed)
    groups = {f"g{i}": doubles(rng, rng.choice([1, 2, 5, 40])) for i in range(150)}
    groups["cancel"] = [1e300, 1.0, -1e300, 1e-200, 2.0**-900]
    groups["tie"] = [2.0**53, 1.0, 2.0**-300]  # above the tie by a bit far below
    groups["tie down"] = [2.0**53, 1.0]
    groups["negative"] = [-(2.0**53), -1.0, -(2.0**-300)]
    groups["zero"] = [1.5, -1.5, 0.0]
    groups["large"] = [1.7e308, -1.7e308, 1.7e308]
    groups["sevenths"] = [1 / 7] * 1000
    rows = [(k, x, -x) for k, xs in groups.items() for x in xs]
    rng.shuffle(rows)
    got = E.exact_sums(spark.createDataFrame(rows, SCHEMA), ["k"], "x", "y", counts=True).collect()
    assert len(got) == len(groups)
    for r in got:
        want = math.fsum(groups[r.k])
        assert r.n == len(groups[r.k]) and (bits(r.x) == bits(want) or (r.x == want == 0)), (r, want, groups[r.k])
        assert r.y == -want


def test_nulls_and_what_is_not_finite(spark):
    inf, nan = math.inf, math.nan
    rows = [("null", None, 1.0), ("null", 1.0, 2.0), ("nan", nan, 1.0), ("nan", 1.0, 1.0), ("inf", inf, -inf), ("inf", 1.0, 5.0),
            ("both", inf, 0.0), ("both", -inf, 0.0), (None, 0.1, 0.2), (None, 0.2, 0.1), ("over", 1.7e308, 0.0), ("over", 1.7e308, 0.0)]
    got = {r.k: (bits(r.x), bits(r.y)) for r in E.exact_sums(spark.createDataFrame(rows, SCHEMA), ["k"], "x", "y").collect()}
    third = bits(math.fsum([0.1, 0.2]))
    assert got == {
        "null": (None, bits(3.0)), "nan": ("nan", bits(2.0)), "inf": (bits(inf), bits(-inf)), "both": ("nan", bits(0.0)),
        None: (third, third), "over": (bits(inf), bits(0.0)),
    }
    assert E.exact_sums(spark.createDataFrame([], SCHEMA), ["k"], "x").collect() == []


def test_same_bits_in_any_order_and_partitions(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)).alias("k"),
        (F.sin("id") * F.pow(F.lit(10.0), F.col("id") % 30 - 15)).alias("x"),
    )
    plain, exact = set(), set()
    for n in (1, 7, 64):
        dealt = rows.repartition(n, F.xxhash64("id", F.lit(n)) if "id" in rows.columns else F.xxhash64("x", F.lit(n)))
        exact.add(tuple(sorted((r.k, bits(r.x)) for r in E.exact_sums(dealt, ["k"], "x").collect())))
        plain.add(tuple(sorted((r.k, bits(r.x)) for r in dealt.groupBy("k").agg(F.sum("x").alias("x")).collect())))
    assert len(exact) == 1 and len(plain) > 1


def test_sums_combine_before_the_shuffle_and_stay_in_the_jvm(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("x"))
    text = E.exact_means(df, ["k"], "x")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Window" not in text
    assert "partial_sum" in text[text.index("Exchange hashpartitioning") :]
