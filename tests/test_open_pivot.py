"""Pivots whose members no list names."""

import pytest

from scenlens.operators import open_pivot as P

SCHEMA = "s string, y int, m string, k int, v double"
ROWS = [("a", 1, "x", 1, 1.0), ("a", 1, "y", 1, None), ("a", 2, "x", 2, 3.0), (None, 1, "é z", 1, 4.0), ("b", 1, "y", 3, 5.0)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def cells(df):
    return {tuple(r[:-1]): r.cells for r in df.collect()}


def test_members_come_from_the_data(spark):
    df = frame(spark)
    assert cells(P.pivot_open(df, ["s", "y"], "m", "v")) == {
        ("a", 1): {"x": 1.0, "y": None}, ("a", 2): {"x": 3.0}, (None, 1): {"é z": 4.0}, ("b", 1): {"y": 5.0}
    }
    assert cells(P.pivot_open(df, ["s"], ["m", "k"], "v")) == {
        ("a",): {"x_1": 1.0, "x_2": 3.0, "y_1": None}, (None,): {"é z_1": 4.0}, ("b",): {"y_3": 5.0}
    }
    assert {r.member for r in P.members(df, "m").collect()} == {"x", "y", "é z"}
    filled = cells(P.pivot_open(df, ["s", "y"], "m", "v", fill=0))
    assert filled["a", 2] == {"x": 3.0, "y": 0.0, "é z": 0.0} and filled["a", 1]["y"] == 0.0
    more = frame(spark, [*ROWS, ("c", 9, "new member", 0, 9.0)])
    assert P.pivot_open(more, ["s", "y"], "m", "v").schema == P.pivot_open(df, ["s", "y"], "m", "v").schema
    assert cells(P.pivot_open(more, ["s", "y"], "m", "v"))["c", 9] == {"new member": 9.0}


def test_columns_and_back(spark):
    pivoted = P.pivot_open(frame(spark), ["s", "y"], "m", "v")
    wide = P.widened(pivoted, ["y", "none"])
    assert wide.columns == ["s", "y", "y", "none"] or wide.columns == ["s", "y", "y", "none"]
    kept = P.widened(P.pivot_open(frame(spark), ["s"], ["m", "k"], "v"), ["x_1", "none"], other="keep").collect()
    assert {(r.s, r.x_1, r.none, tuple(r.cells)) for r in kept} == {("a", 1.0, None, ("x_2", "y_1")), (None, None, None, ("é z_1",)), ("b", None, None, ("y_3",))}
    back = P.long_cells(pivoted, "m", "v").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((s, y, m, v)) for s, y, m, _, v in ROWS)
    with pytest.raises(ValueError, match="drop or keep"):
        P.widened(pivoted, [], other="x")


def test_two_pivots_as_one(spark):
    df = frame(spark)
    left = P.pivot_open(df.filter("m <> 'y'"), ["s"], ["m", "k"], "v")
    right = P.pivot_open(df.filter("m = 'y' or k = 2").withColumn("v", df.v * 10), ["s"], ["m", "k"], "v")
    assert cells(P.join_pivots(left, right, ["s"])) == {("a",): {"x_1": 1.0, "x_2": 30.0, "y_1": None}, (None,): {"é z_1": 4.0}}


def test_what_fails(spark):
    df = frame(spark)
    for rows, match in (([*ROWS, ROWS[0]], "more than one row"), ([*ROWS, ("a", 7, None, 1, 1.0)], "without a member")):
        with pytest.raises(Exception, match=match):
            P.pivot_open(frame(spark, rows), ["s", "y"], "m", "v").collect()
    with pytest.raises(Exception, match="more than 2 members: 3"):
        P.pivot_open(df, ["s", "y"], "m", "v", most=2).collect()
    assert P.pivot_open(df, ["s", "y"], "m", "v", most=3).count() == 4
    with pytest.raises(ValueError, match="exist already"):
        P.pivot_open(df.withColumnRenamed("s", "cells"), ["cells"], "m", "v")
    assert P.pivot_open(df.limit(0), ["s"], "m", "v").collect() == []
    assert P.pivot_open(df.limit(0), ["s"], "m", "v", fill=0).collect() == []
