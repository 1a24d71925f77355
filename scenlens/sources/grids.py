"""Gridded variables cut into tiles.

A variable over a fine grid is millions of cells; stored as one array it would be one row and one task.
Here it is stored as tiles: a tile has its first column and row, its width, and its values row by row. Rows
are exploded tile by tile, and a cell's place follows from its index by arithmetic, so a task holds tiles and
nothing else, and a filter on columns and rows reaches the tiles' own columns.

A regular axis is a start and a step; an irregular one is a list of coordinates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

TILE_CELLS = 1 << 20  # a tile with more cells is refused


@dataclass(frozen=True)
class Axis:
    """Coordinates by index: ``start + step * index``, or the listed ones."""

    start: float = 0.0
    step: float = 1.0
    listed: Sequence[float] | None = None

    def at(self, index: Column) -> Column:
        if self.listed is None:
            return F.lit(float(self.start)) + index * F.lit(float(self.step))
        found = F.get(F.array(*[F.lit(float(x)) for x in self.listed]), index.cast("int"))
        message = F.concat(F.lit("no coordinate of index "), index.cast("string"))
        return F.when(found.isNotNull(), found).otherwise(F.raise_error(message).cast("double"))

    def indices(self, lo: float, hi: float) -> tuple[int, int]:
        """First and last index of the coordinates within lo..hi; (0, -1) if there are none."""
        if self.listed is not None:
            inside = [i for i, x in enumerate(self.listed) if lo <= x <= hi]
            return (min(inside), max(inside)) if inside else (0, -1)
        ends = sorted(((lo - self.start) / self.step, (hi - self.start) / self.step))
        return -int(-ends[0] // 1), int(ends[1] // 1)


def tile_rows(
    tiles: DataFrame, lon: Axis, lat: Axis, value: str = "value", bounds: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Tiles (col0, row0, width, an array of values, and other columns) to rows (others, lon, lat, value).

    Cells that are null or NaN have no row. A tile whose values don't fill whole rows fails the job, as does
    one of more than ``TILE_CELLS`` cells. ``bounds`` (west, south, east, north) keeps the cells inside: tiles
    outside are left out by their own columns before any array is read.
    """
    rest = [c for c in tiles.columns if c not in ("col0", "row0", "width", value)]
    n = F.size(value)
    if bounds is not None:
        west, south, east, north = bounds
        cols, rows = lon.indices(west, east), lat.indices(south, north)
        height = F.ceil(n / F.col("width"))
        tiles = tiles.filter((F.col("col0") <= cols[1]) & (F.col("row0") <= rows[1]) & (F.col("col0") + F.col("width") > cols[0]))
        tiles = tiles.filter(F.col("row0") + height > rows[0])
    good = (F.col("width") > 0) & (n % F.col("width") == 0) & (n <= TILE_CELLS)
    message = F.concat(F.lit("no tile: "), n.cast("string"), F.lit(" cells of width "), F.col("width").cast("string"))
    checked = tiles.filter(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    cells = checked.select(*[F.col(f"`{c}`") for c in rest], "col0", "row0", "width", F.posexplode(value).alias("__i", "__v"))
    col = F.col("col0") + F.col("__i") % F.col("width")
    row = F.col("row0") + F.floor(F.col("__i") / F.col("width"))
    if bounds is not None:
        cells = cells.filter(col.between(*cols) & row.between(*rows))
    filled = F.col("__v").isNotNull()
    if cells.schema["__v"].dataType.typeName() in ("float", "double"):
        filled = filled & ~F.isnan("__v")
    return cells.filter(filled).select(
        *[F.col(f"`{c}`") for c in rest], lon.at(col).alias("lon"), lat.at(row).alias("lat"), F.col("__v").alias(value)
    )


def cut_into_tiles(
    cells: DataFrame, keys: Sequence[str], width: int, height: int, value: str = "value", n_cols: int | None = None
) -> DataFrame:
    """Rows (keys, col, row, value) to tiles of at most width x height cells; the last column of tiles may be narrower.

    Only tiles with a cell exist. Cells without a row are null in their tile. A second row for one cell fails
    the job. Rows are combined per tile, whose size is fixed, so no group grows with the grid.
    """
    if width * height > TILE_CELLS:
        raise ValueError(f"a tile of {width} x {height} cells has more than {TILE_CELLS}")
    col0 = (F.floor(F.col("col") / width) * width).cast("int")
    row0 = (F.floor(F.col("row") / height) * height).cast("int")
    own = F.lit(width) if n_cols is None else F.least(F.lit(width), F.lit(n_cols) - col0)
    placed = cells.select(
        *[F.col(f"`{c}`") for c in keys], col0.alias("col0"), row0.alias("row0"), own.cast("int").alias("width"),
        ((F.col("row") - row0) * own + F.col("col") - col0).cast("int").alias("__i"), F.col(value).alias("__v"),
    )
    grouped = placed.groupBy(*keys, "col0", "row0", "width").agg(
        F.collect_list(F.struct("__i", "__v")).alias("__cells"), F.count(F.lit(1)).alias("__n"), F.max("__i").alias("__last")
    )
    by_index = F.map_from_entries("__cells")  # fails on a second row for one cell
    n = F.ceil((F.col("__last") + 1) / F.col("width")) * F.col("width")
    values = F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.try_element_at(F.col("__map"), i))
    return grouped.withColumn("__map", by_index).select(*keys, "col0", "row0", "width", values.alias(value))
