"""Places and ranks against sorted lists, and the plans behind them."""

import random

import pytest
from pyspark.sql import functions as F

from scenlens.operators import ranking as K


def rows(n=900):
    rng = random.Random(1)
    return [(i, rng.choice(["a", "b", None, "9", "10", "é"]), rng.choice([None, 1, 2, 3]) if i % 3 else 2) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, k string, v long").repartition(5)


def test_places_follow_the_order(spark):
    data = rows()
    got = K.placed(frame(spark, data), [F.col("k").desc_nulls_last(), "v", "id"], running={"before": "v"}).collect()
    low = sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
    known = sorted((r for r in low if r[1] is not None), key=lambda r: r[1], reverse=True)
    want = known + [r for r in low if r[1] is None]
    total = 0
    for place, (row, r) in enumerate(zip(want, sorted(got, key=lambda r: r.place), strict=True)):
        assert (r.place, r.before, r.id) == (place, total, row[0])
        total += row[2] or 0


def test_equal_rows_have_places_of_their_own(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"))
    got = K.placed(df, ["k"]).collect()
    assert sorted(r.place for r in got) == list(range(3000))
    assert [r.k for r in sorted(got, key=lambda r: r.place)] == sorted(r.k for r in got)


@pytest.mark.parametrize("dense", [False, True])
def test_ranks(spark, dense):
    data = rows()
    got = K.ranked(frame(spark, data), ["v", "k"], ["k", "v"], dense=dense).collect()
    order = lambda r: (r[2] is not None, r[2] or 0, r[1] is not None, r[1] or "")
    keys = sorted(map(order, data))
    firsts = {k: keys.index(k) + 1 for k in keys} if not dense else {k: i + 1 for i, k in enumerate(sorted(set(keys)))}
    assert {r.id: r["rank"] for r in got} == {r[0]: firsts[order(r)] for r in data}


def test_no_rows_and_clashing_names(spark):
    empty = frame(spark, []).limit(0)
    assert K.placed(empty, ["k"]).collect() == [] and K.ranked(empty, ["k"], ["k"]).collect() == []
    with pytest.raises(ValueError, match="exist already"):
        K.placed(empty, ["k"], place="v")


def test_no_task_numbers_all_rows(spark):
    """The rows stay in many partitions; what one task sees has a row for each of them."""
    n = spark.range(0, 5000, 1, 8).select("id", (F.col("id") % 7).cast("string").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are joined otherwise
    try:
        out = K.placed(n, K.numeric_order("k"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(*out.inputFiles()).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3000
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in text
    single = text[text.index("SinglePartition") :] if "SinglePartition" in text else ""
    assert single.splitlines()[1].strip(" +-:").startswith(("HashAggregate", "*(")) and "HashAggregate" in single.splitlines()[1]
