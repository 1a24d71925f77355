"""Tiles against the cells they are made of."""

import random

import pytest
from pyspark.sql import functions as F

from scenlens.sources import grids as G

CELLS = "name string, col int, row int, value double"


def cells(n_cols=23, n_rows=17):
    rng = random.Random(4)
    return [(name, c, r, rng.random()) for name in ("a", "b") for c in range(n_cols) for r in range(n_rows) if rng.random() < 0.7]


@pytest.mark.parametrize("width, height", [(1, 1), (5, 4), (23, 17), (40, 40)])
def test_tiles_hold_the_cells(spark, width, height):
    data = cells()
    tiles = G.cut_into_tiles(spark.createDataFrame(data, CELLS), ["name"], width, height, n_cols=23)
    for t in tiles.collect():
        assert len(t.value) <= width * height and len(t.value) % t.width == 0 and t.col0 + t.width <= 23
    lon, lat = G.Axis(10.0, 0.25), G.Axis(listed=[-5.0 * i * i for i in range(17)])
    got = G.tile_rows(tiles, lon, lat)
    assert {tuple(r) for r in got.collect()} == {(n, 10 + 0.25 * c, -5.0 * r * r, v) for n, c, r, v in data}
    inside = G.tile_rows(tiles, lon, lat, bounds=(11.0, -200.0, 13.5, -4.0)).collect()
    assert {tuple(r) for r in inside} == {tuple(r) for r in got.collect() if 11 <= r.lon <= 13.5 and -200 <= r.lat <= -4}


def test_missing_cells_and_bad_tiles(spark):
    tiles = [("a", 0, 0, 2, [1.0, None, float("nan"), 4.0])]
    schema = "name string, col0 int, row0 int, width int, value array<double>"
    assert sorted(tuple(r) for r in G.tile_rows(spark.createDataFrame(tiles, schema), G.Axis(), G.Axis()).collect()) == [
        ("a", 0.0, 0.0, 1.0), ("a", 1.0, 1.0, 4.0)
    ]
    for bad in (("a", 0, 0, 3, [1.0, 2.0]), ("a", 0, 0, 0, [1.0])):
        with pytest.raises(Exception, match="no tile"):
            G.tile_rows(spark.createDataFrame([bad], schema), G.Axis(), G.Axis()).collect()
    with pytest.raises(Exception, match="no coordinate of index 1"):
        G.tile_rows(spark.createDataFrame(tiles, schema), G.Axis(listed=[0.0]), G.Axis()).collect()
    twice = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 1, 1, 2.0)], CELLS)
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|Duplicate map key"):
        G.cut_into_tiles(twice, ["name"], 4, 4).collect()
    with pytest.raises(ValueError, match="more than"):
        G.cut_into_tiles(twice, ["name"], 2000, 2000)
    assert G.tile_rows(G.cut_into_tiles(twice.limit(0), ["name"], 4, 4), G.Axis(), G.Axis()).collect() == []


def test_integer_values_and_falling_axes():
    assert G.Axis(0.0, 0.5).indices(0.9, 2.0) == (2, 4) and G.Axis(10.0, -1.0).indices(7.5, 9.0) == (1, 2)
    assert G.Axis(listed=[5.0, 1.0, 3.0]).indices(2.0, 9.0) == (0, 2) and G.Axis(listed=[5.0]).indices(6, 7) == (0, -1)


def test_a_task_holds_tiles_and_no_grid(spark, tmp_path):
    """A grid of 400 x 300 cells is 400 tiles in many rows; a window prunes them by their own columns."""
    grid = spark.range(120_000).select(
        F.lit("a").alias("name"), (F.col("id") % 400).cast("int").alias("col"), F.floor(F.col("id") / 400).cast("int").alias("row"),
        F.col("id").cast("double").alias("value"),
    )
    G.cut_into_tiles(grid, ["name"], 20, 15).write.parquet(str(tmp_path / "t"))
    tiles = spark.read.parquet(str(tmp_path / "t"))
    assert tiles.count() == 400 and tiles.select(F.max(F.size("value"))).first()[0] == 300
    window = G.tile_rows(tiles, G.Axis(), G.Axis(), bounds=(0, 0, 39, 29))
    text = window._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(col0,39)" in text
    assert window.agg(F.count("*"), F.sum("value")).first() == (1200, sum(r * 400 + c for r in range(30) for c in range(40)))
