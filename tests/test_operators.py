import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scenlens.operators import aggregation as G
from scenlens.operators import joins as J
from scenlens.operators import reshape as R
from scenlens.operators import rows as W


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([("a", 10), ("b", None), (None, 30)], "k string, y int")


def test_left_join_null_keys(left, right):
    assert rows(J.left_join(left, right, "k")) == [("a", 1, 10), ("b", 2, None), (None, 3, None)]
    matched = J.left_join(left, right, "k", null_keys=True)
    assert rows(matched) == [("a", 1, 10), ("b", 2, None), (None, 3, 30)]


def test_natural_joins(left, right):
    assert rows(J.natural_inner_join(left, right)) == [("a", 1, 10), ("b", 2, None)]
    assert len(rows(J.natural_left_join(left, right))) == 3
    with pytest.raises(ValueError, match="cross join"):
        J.natural_inner_join(left, right.drop("k"))


def test_clashing_names_are_refused(left):
    with pytest.raises(ValueError, match="both sides"):
        J.left_join(left, left, "k")


def test_strict_join_passes(left, right):
    joined = J.strict_left_join(left, right, "k", null_keys=True)
    assert rows(joined) == [("a", 1, 10), ("b", 2, None), (None, 3, 30)]


def test_strict_join_is_lazy_and_fails_on_unmatched(left, right):
    joined = J.strict_left_join(left, right.filter("k = 'a'"), "k")
    with pytest.raises(PySparkException, match="no match for"):
        joined.collect()
    with pytest.raises(PySparkException, match="no match for"):
        joined.select("x").collect()


def test_strict_join_fails_on_duplicate_right_key(left, right):
    with pytest.raises(PySparkException, match="more than one row for key"):
        J.strict_left_join(left, right.unionAll(right), "k", null_keys=True).collect()


def test_strict_join_can_refuse_nulls(left, right):
    with pytest.raises(PySparkException, match="no match for"):
        J.strict_left_join(left, right, "k", null_keys=True, reject_null=True).collect()


def test_full_join(left, right):
    got = rows(J.full_join(left.filter("x < 2"), right.filter("y = 30 OR k = 'a'"), "k"))
    assert got == [("a", 1, 10), (None, None, 30)]


@pytest.mark.parametrize("bounded", [True, False])
def test_attach_baseline(spark, bounded):
    df = spark.createDataFrame(
        [("base", 2020, 1.0), ("s", 2020, 4.0), ("base", 2030, 2.0), ("s", 2030, 1.0)],
        "scenario string, year int, v double",
    )
    is_base = F.col("scenario") == "base"
    joined = J.attach_baseline(df, is_base, "year", ["v"], bounded=bounded)
    diffs = rows(joined.select("scenario", "year", F.col("v") - F.col("v_base")))
    assert diffs == [("base", 2020, 0.0), ("base", 2030, 0.0), ("s", 2020, 3.0), ("s", 2030, -1.0)]
    gap = df.filter(~(is_base & (F.col("year") == 2030)))
    with pytest.raises(PySparkException, match="no (match|baseline) for"):
        J.attach_baseline(gap, is_base, "year", ["v"], bounded=bounded).collect()
    with pytest.raises(PySparkException, match="more than one row"):
        J.attach_baseline(df.unionAll(df), is_base, "year", ["v"], bounded=bounded).collect()


def test_attach_scalar(left):
    got = J.attach_scalar(left, left.filter("k = 'b'"), {"base": "x"})
    assert rows(got) == [("a", 1, 2), ("b", 2, 2), (None, 3, 2)]
    for bad in (left, left.filter("x > 9")):
        with pytest.raises(Exception, match="expected one row"):
            J.attach_scalar(left, bad, {"base": "x"}).collect()


def test_cross_scenarios(left):
    assert len(rows(J.cross_scenarios(left, ["s", "t"]))) == 6


def test_shares_sum_to_one_and_unknown_totals_stay_unknown(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", None), ("z", 0.0)], "k string, v double"
    )
    got = rows(G.share_of_total(df, ["k"], "v", "share"))
    assert got == [
        ("a", 1.0, 0.25), ("a", 3.0, 0.75), ("b", 2.0, None), ("b", None, None), ("z", 0.0, None),
    ]


def test_calibrate(spark):
    df = spark.createDataFrame(
        [("s", "r", 2020, 1.0), ("s", "r", 2020, 3.0), ("s", "r", 2030, 5.0)],
        "scenario string, region string, year int, v double",
    )
    seen = spark.createDataFrame([("r", 4.0)], "region string, seen double")
    args = (["scenario", "region"], ["region"], "v", "seen", 2020, "scaled", "factor")
    got = rows(G.calibrate(df, seen, *args).select("year", "factor", "scaled"))
    assert got == [(2020, 2.0, 2.0), (2020, 2.0, 6.0), (2030, 2.0, 10.0)]
    with pytest.raises(PySparkException, match="no match"):
        G.calibrate(df.filter("year > 2020"), seen, *args).collect()


def test_grouped_sums(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 4.0)], "k string, i int, d double")
    assert rows(G.sum_numeric_by(df, ["k"])) == [("a", 4, 6.0)]
    assert rows(G.mean_by(df, ["k"], "d")) == [("a", 3.0)]
    assert rows(G.weighted_ratio(df, ["k"], "d", {"o": "i", "p": "d"})) == [("a", 3.5, 20 / 6)]


def test_row_helpers(spark):
    df = spark.createDataFrame(
        [("a", 2010, 1.0), ("b", 2020, None), (None, 2030, 3.0)], "s string, year int, v double"
    )
    assert len(rows(W.between_years(df, 2020))) == 2
    assert len(rows(W.between_years(df, hi=2010))) == 1
    assert len(rows(W.isin_years(df, [2010, 2030]))) == 2
    assert rows(W.match_rows(df, "s", "^a")) == [("a", 2010, 1.0)]
    assert len(rows(W.match_rows(df, "s", "^a", negate=True))) == 2
    assert len(rows(W.complete_cases(df))) == 1
    assert len(rows(W.complete_cases(df, ["v"]))) == 2
    assert [r[2] for r in rows(W.zero_fill(df, ["year"]))] == [1.0, 0.0, 3.0]
    assert [r.v for r in W.scale(df, "v", 2).collect()] == [2.0, None, 6.0]
    assert [r.v for r in W.map_numeric(df, lambda c: -c, ["year"]).collect()] == [-1.0, None, -3.0]
    patched = W.patch_value(df, "v", F.col("s") == "a", F.lit(9.0))
    assert [r.v for r in patched.collect()] == [9.0, None, 3.0]
    assert W.cols_matching(df, lambda c: c.startswith("y")) == ["year"]


def test_report_columns_and_order(spark):
    df = spark.createDataFrame([("x", "10", 1, 2, 3), ("x", "9", 4, 5, 6), ("x", "?", 7, 8, 9)], "u string, g string, trn_1 int, a_1 int, afolu_1 int")
    ordered = W.order_report(df, ["g"], ["afolu", "trn"])
    assert ordered.columns == ["g", "afolu_1", "trn_1"]
    assert [r.g for r in W.sort_numeric(ordered, "g").collect()] == ["9", "10", "?"]
    assert [r.g for r in W.sort_report(df, "u", "g").collect()] == ["9", "10", "?"]


def test_strip_prefix(spark):
    df = spark.createDataFrame([(1, 2)], "`q.t.year` int, `q.value` int")
    assert W.strip_prefix(df).columns == ["year", "value"]
    with pytest.raises(ValueError, match="ambiguous"):
        W.strip_prefix(spark.createDataFrame([(1, 2)], "`a.x` int, `b.x` int"))


def test_pivot_roundtrip(spark):
    df = spark.createDataFrame([("a", 2010, 1.0), ("a", 2020, 2.0), ("b", 2020, 3.0)], "k string, year int, v double")
    wide = R.pivot_years(df, ["k"], [2010, 2020], "v")
    assert rows(wide) == [("a", 1.0, 2.0), ("b", None, 3.0)]
    named = wide.withColumnsRenamed({"2010": "X2010", "2020": "X2020"})
    back = R.unpivot_years(named, ["k"], "X", "v").dropna()
    assert rows(back) == rows(df)
    with pytest.raises(PySparkException, match="more than one row"):
        R.pivot_years(df.unionAll(df), ["k"], [2010, 2020], "v").collect()


def test_pivot_complete_keeps_whole_ids_only(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("c", "x", 4.0), ("c", "y", None)], "k string, n string, v double")
    assert rows(R.pivot_complete(df, ["k"], "n", "v", ["x", "y"])) == [("a", 1.0, 2.0)]


def test_merge_all_groups_needs_every_group(spark):
    df = spark.createDataFrame(
        [(5, "g1", "x_1", 1.0), (5, "g2", "x_2", 2.0), (10, "g1", "x_1", 3.0), (20, "g1", "x_1", 1.0), (20, "g2", "other", 9.0)],
        "id int, g string, n string, v double",
    )
    got = R.merge_all_groups(df, ["id"], "g", ["g1", "g2"], "n", "v", ["x_1", "x_2"], other="drop")
    assert rows(got) == [(20, 1.0, None), (5, 1.0, 2.0)]
    with pytest.raises(Exception, match="not listed: other"):
        R.merge_all_groups(df, ["id"], "g", ["g1", "g2"], "n", "v", ["x_1", "x_2"]).collect()


def test_more_members_than_one_mask_holds(spark):
    names = [f"m{i}" for i in range(150)]
    df = spark.createDataFrame([(i, n, float(i)) for i in (1, 2) for n in names[i - 1 :]], "id int, n string, v double")
    got = R.merge_all_groups(df, ["id"], "n", names, "n", "v", names).collect()
    assert [r.id for r in got] == [1] and got[0].m149 == 1.0


def test_unlisted_member_fails(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, None, 2.0)], "id int, n string, v double")
    assert rows(R.pivot_members(df, ["id"], "n", "v", ["a"], other="drop")) == [(1, 1.0)]
    with pytest.raises(Exception, match="not listed: null"):
        R.pivot_members(df, ["id"], "n", "v", ["a"]).collect()


def test_two_period_needs_both_years(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2050, 2.0), ("b", 2020, 3.0), ("a", 2030, 8.0)], "k string, year int, v double")
    assert rows(R.two_period(df, ["k"], 2020, 2050, ["v"])) == [("a", 1.0, 2.0)]


def test_complete(spark):
    df = spark.createDataFrame(
        [("a", 2005, 1.0), ("a", 2007, 2.0), ("b", 2010, None), ("b", 2010, 4.0)], "k string, year int, v double"
    )
    got = rows(R.complete(df, ["k"], [2005, 2010], {"v": 0.0}))
    assert got == [("a", 2005, 1.0), ("a", 2007, 2.0), ("a", 2010, 0.0), ("b", 2005, 0.0), ("b", 2010, 0.0), ("b", 2010, 4.0)]


def test_fold_and_duplicate(spark):
    df = spark.createDataFrame([("RUE", 1.0), ("RUS", 2.0), ("X", None)], "region string, v double")
    assert rows(R.fold_member(df, "region", "RUE", "RUS", ["region"], "v")) == [("RUS", 3.0), ("X", None)]
    only = df.filter("region = 'RUE'")
    assert rows(R.fold_member(only, "region", "RUE", "RUS", ["region"], "v")) == [("RUS", 1.0)]
    assert len(rows(R.duplicate_member(df, F.col("region") == "RUE", region="TWN", v=1))) == 4


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert rows(R.union_by_name(a, b)) == [(1, 2, None), (4, None, 3)]
