"""Plans and skew: what has to hold when the tables are large."""

import re

import pytest
from pyspark.sql import functions as F

from scenlens.operators import aggregation as G
from scenlens.operators import joins as J
from scenlens.operators import reshape as R
from scenlens.operators.spatial import point_in_polygon
from scenlens.plans import land as L
from scenlens.plans import water as W


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return plan(df)


@pytest.fixture
def conf(spark):
    changed = {}

    def put(**settings):
        for k, v in settings.items():
            k = "spark.sql." + k.replace("__", ".")
            changed.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in changed.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """A third of all rows has one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000))
    return spark.range(n).select(
        key.alias("k"), "id", F.col("id").cast("double").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )


def test_shares_of_a_hot_group_do_not_meet_in_one_task(spark, conf):
    """Small totals are broadcast; large ones are sort-merged with the hot partition split."""
    df = hot(spark)
    small = G.share_of_total(df, ["k"], "v", "share")
    assert "Window" not in plan(small)
    assert "BroadcastHashJoin" in executed(small)
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    large = G.share_of_total(df, ["k"], "v", "share")
    assert "skew=true" in executed(large)
    one = large.groupBy("k").agg(F.sum("share").alias("s")).filter(F.abs(F.col("s") - 1) > 1e-9)
    assert one.count() == 0


def test_strict_join_on_a_hot_key_is_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    df = hot(spark)
    right = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = J.strict_left_join(df, right, "k", spread=True)
    assert "skew=true" in executed(joined)
    assert joined.count() == 60_000


@pytest.mark.parametrize(
    "build",
    [
        lambda df: G.sum_by(df, ["k"], "v"),
        lambda df: R.fold_member(df, "k", "k1", "hot", ["k"], "v"),
        lambda df: df.transform(lambda d: R.merge_all_groups(
            d.withColumn("g", F.lit("g")).withColumn("m", F.col("id").cast("string")), ["k"], "g", ["g"], "m", "v", ["1"])),
    ],
)
def test_aggregates_combine_before_the_shuffle(spark, build):
    text = plan(build(hot(spark)))
    first = text.index("Exchange hashpartitioning")
    assert "partial_" in text[first:] and text.count("Exchange hashpartitioning") == 1


def test_complete_shuffles_combinations_once_and_joins_nothing(spark):
    df = hot(spark).withColumn("year", (F.col("id") % 5 + 2000).cast("int"))
    text = plan(R.complete(df.select("k", "year", "v"), ["k"], [2000, 2001, 2010], {"v": 0.0}))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_grid_is_shuffled_once(spark):
    grid = spark.range(1000).select(
        F.lit("s").alias("scenario"), F.lit(2020).alias("year"), F.col("id").cast("double").alias("lon"),
        F.col("id").cast("double").alias("lat"), F.lit("forest").alias("landclass"), F.lit(1.0).alias("value"),
    )
    text = plan(L.grid_periods(grid, ("forest", "pasture")))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_" in text and "Join" not in text


def test_no_cross_joins_and_no_python_in_registered_plans(spark):
    from pathlib import Path

    from scenlens.workload.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("no test data")
    for name, fn in QUERIES.items():
        text = plan(fn(spark, sf))
        assert not re.search("CartesianProduct|NestedLoop|Python|Arrow", text), name


def test_scans_read_needed_columns_and_push_filters(spark, tmp_path):
    path = str(tmp_path / "water")
    spark.range(10).select(
        F.lit("s").alias("scenario"), F.lit("b").alias("basin"), F.lit("runoff").alias("subresource"),
        (F.col("id") + 2010).cast("int").alias("year"), F.lit("km^3").alias("Units"), F.lit(1.0).alias("value"),
        F.lit("x").alias("unused"),
    ).write.parquet(path)
    table = spark.read.parquet(path)
    supply = table.drop("unused").withColumnRenamed("value", "value_sup")
    index = W.water_scarcity_runoff(W.water_scarcity(supply, table.drop("unused").withColumnRenamed("value", "value_wd")))
    text = plan(index)
    assert "unused" not in text
    assert re.search(r"PushedFilters: \[.*EqualTo\(year,2015\)", text)
    assert re.search(r"PushedFilters: \[.*EqualTo\(subresource,runoff\)", text) or "subresource" in text


def test_points_meet_only_the_edges_of_their_cell(spark):
    points = spark.range(2000).select("id", (F.col("id") % 50).cast("double").alias("x"), (F.col("id") / 40).alias("y"))
    ring = [(0.0, 0.0), (40.0, 5.0), (30.0, 45.0), (5.0, 30.0)]
    edges = [(1, *a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]
    df = point_in_polygon(points, spark.createDataFrame(edges, "poly_id int, x1 double, y1 double, x2 double, y2 double"), 1.0, ("id",))
    text = plan(df)
    assert not re.search("CartesianProduct|NestedLoop", text)
    assert re.search(r"(SortMergeJoin|HashJoin) \[ci#\d+L, cj#\d+L\]", text)


def test_baseline_broadcast_is_bounded_by_the_window(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") < 7, "base").otherwise(F.concat(F.lit("s"), F.floor(F.col("id") / 7))).alias("scenario"),
        (F.col("id") % 7 + 2020).cast("int").alias("year"), F.col("id").cast("double").alias("v"),
    )
    joined = J.attach_baseline(df, F.col("scenario") == "base", "year", ["v"], bounded=True)
    assert "BroadcastHashJoin" in plan(joined) and joined.count() == 10_000


def test_strict_join_shuffles_each_side_once(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    df = hot(spark)
    joined = J.strict_left_join(df, df.groupBy("k", "id").agg(F.max("v").alias("w")), ["k", "id"])
    assert executed(joined).split("Initial Plan")[0].count("Exchange hashpartitioning") == 2
