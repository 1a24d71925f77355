"""Points in polygons as an equi-join.

Spark has no spatial join, and a ray cast from every point against every edge does not scale: each point
would meet all the edges of its latitude. Here the plane is cut into square cells and a point only meets
the edges that pass through its own cell.

For one polygon and one point p in a cell with lower-left corner c, the parity of a leftward ray from p is

    parity(c)  xor  over the edges e of the cell:  ray(e, p) ^ ray(e, c) ^ strip(v1) ^ strip(v2)

where ``ray(e, q)`` says whether e crosses the leftward ray from q, and ``strip(v)`` whether vertex v lies
left of c between the heights of c and p. Summed over a closed ring the strip terms cancel, and for an
edge outside the cell the four terms cancel by themselves, so the identity holds for any ring. Since it
only combines the same predicate at two points, it needs no special case for rays through vertices.

``parity(c)`` is constant data of the polygons: the edges crossing a grid line flip the parity of every
corner to their right, so the inside corners of a line are runs between consecutive flips.

Cells may have several sizes: where many edges meet in a cell, smaller cells take its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scenlens.operators.reshape import union_by_name
from scenlens.sources.shared import staged

_PAD = 1e-9


def _ray(x1, y1, x2, y2, qx, qy) -> Column:
    """Whether the edge (lower end first) crosses the leftward horizontal ray from (qx, qy)."""
    spans = (y1 <= qy) & (qy < y2)
    return spans & (((qy - y1) * (x2 - x1) - (qx - x1) * (y2 - y1)) < 0)


def _edges(edges: DataFrame) -> DataFrame:
    """Edges with the lower end first; both engines of a shared border then see the same numbers."""
    up = F.col("y1") <= F.col("y2")
    return edges.select(
        "poly_id",
        *[
            F.when(up, F.col(a)).otherwise(F.col(b)).cast("double").alias(a)
            for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))
        ],
    )


def _range(lo: Column, hi: Column) -> Column:
    """Integers lo..hi, none if lo > hi."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(cell)).cast("bigint")


def _edge_cells(edges: DataFrame, cell: float) -> DataFrame:
    """One row per edge and cell it passes through (a long diagonal takes a staircase, not its box)."""
    lo, hi = F.col("y1"), F.col("y2")
    rows = edges.withColumn("cj", F.explode(_range(_cell(lo - _PAD, cell), _cell(hi + _PAD, cell))))
    bottom = F.greatest(lo, F.col("cj") * cell - _PAD)
    top = F.least(hi, (F.col("cj") + 1) * cell + _PAD)
    slope = F.try_divide(F.col("x2") - F.col("x1"), hi - lo)
    xa = F.coalesce(F.col("x1") + (bottom - lo) * slope, F.col("x1"))
    xb = F.coalesce(F.col("x1") + (top - lo) * slope, F.col("x2"))
    # Rounding at the clipped ends must stay inside the edge's own extent, widened by the pad.
    left, right = F.least("x1", "x2") - _PAD, F.greatest("x1", "x2") + _PAD
    xlo = F.greatest(F.least(xa, xb) - _PAD, left)
    xhi = F.least(F.greatest(xa, xb) + _PAD, right)
    return rows.withColumn("ci", F.explode(_range(_cell(xlo, cell), _cell(xhi, cell))))


def _inside_corners(edges: DataFrame, cell: float) -> DataFrame:
    """Cells (poly_id, ci, cj) whose lower-left corner is inside the polygon."""
    e = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    line = F.col("cj") * F.lit(cell)
    crossing = edges.withColumn(
        "cj", F.explode(_range(_cell(F.col("y1"), cell), _cell(F.col("y2"), cell) + 1))
    ).filter((F.col("y1") <= line) & (line < F.col("y2")))
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    x_at = F.col("x1") + (line - F.col("y1")) * slope
    guess = crossing.withColumn("g", _cell(x_at, cell))
    # First corner right of the crossing, decided by the very predicate the points use.
    tried = [
        F.when(_ray(*e, (F.col("g") + d) * F.lit(cell), line), F.col("g") + d) for d in (-1, 0, 1)
    ]
    flips = (
        guess.withColumn("ci", F.coalesce(*tried, F.col("g") + 2))
        .groupBy("poly_id", "cj", "ci")
        .agg((F.count(F.lit(1)) % 2).alias("odd"))
        .filter(F.col("odd") == 1)
    )
    # At most one flip per cell of a grid line, so a window partition is bounded by 360 / cell rows.
    along = Window.partitionBy("poly_id", "cj").orderBy("ci")
    runs = (
        flips.withColumn("n", F.row_number().over(along))
        .withColumn("stop", F.lead("ci").over(along))
        .filter(F.col("n") % 2 == 1)
    )
    return runs.select(
        "poly_id", "cj", F.explode(_range(F.col("ci"), F.col("stop") - 1)).alias("ci")
    )


def _flip(e: list[Column], p: tuple[Column, Column], c: tuple[Column, Column]) -> Column:
    """The term of an edge in the parity of p, relative to that of the corner c of its cell."""

    def strip(vx: Column, vy: Column) -> Column:
        return (vx < c[0]) & ((vy > c[1]) != (vy > p[1]))

    return (_ray(*e, *p) != _ray(*e, *c)) != (strip(e[0], e[1]) != strip(e[2], e[3]))


def _ends() -> list[Column]:
    return [F.col(c) for c in ("x1", "y1", "x2", "y2")]


def _halved(crowded: DataFrame, features: DataFrame, cell: float) -> DataFrame:
    """The features of crowded cells in cells of half the size.

    Edges are placed anew. A smaller cell's corner is a point of the larger cell, so whether it is inside
    follows from that cell's own corner and edges, by the identity that holds for any point.
    """
    half = cell / 2
    inside = features.join(crowded, ["ci", "cj"], "left_semi")
    is_edge = F.col("x1").isNotNull()
    edges = inside.filter(is_edge).select("poly_id", "edge", *_ends()).distinct()  # of each row once: a ring may repeat an edge
    parents = crowded.select(F.col("ci").alias("__pi"), F.col("cj").alias("__pj"))
    borders = _edge_cells(edges, half).withColumns({"__pi": F.floor(F.col("ci") / 2), "__pj": F.floor(F.col("cj") / 2)})
    borders = borders.join(parents, ["__pi", "__pj"], "left_semi").drop("__pi", "__pj")
    quarters = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    small = inside.withColumn("q", quarters).withColumns({"si": F.col("ci") * 2 + F.col("q.a"), "sj": F.col("cj") * 2 + F.col("q.b")})
    p = (F.col("si") * F.lit(half), F.col("sj") * F.lit(half))
    c = (F.col("ci") * F.lit(cell), F.col("cj") * F.lit(cell))
    bit = F.when(is_edge, _flip(_ends(), p, c).cast("int")).otherwise(F.lit(1))
    corners = (
        small.groupBy("poly_id", F.col("si").alias("ci"), F.col("sj").alias("cj"))
        .agg(F.bit_xor(bit).alias("bit"))
        .filter("bit = 1")
        .select("poly_id", "ci", "cj")
    )
    return borders.unionByName(corners, allowMissingColumns=True)


def polygon_index(edges: DataFrame, cell: float = 0.5, crowd: int | None = None, levels: int = 10) -> tuple[DataFrame, list[int]]:
    """(level, ci, cj, poly_id, edge or null for an inside corner) of all cells, and the levels in use.

    Cells of level n have the size ``cell`` / 2^n. Where more than ``crowd`` edges meet in a cell, its four
    quarters take its place, and so on for at most ``levels`` times: detailed coasts have small cells and
    oceans large ones, and every place belongs to one cell of one level.
    """
    edges = _edges(edges)
    if crowd is not None:
        edges = staged(edges.withColumn("edge", F.monotonically_increasing_id()), "edges")
    features = _edge_cells(edges, cell).unionByName(_inside_corners(edges, cell), allowMissingColumns=True)
    if crowd is None:
        return features.withColumn("level", F.lit(0)), [0]
    out, used = [], []
    for level in range(levels + 1):
        features = staged(features, "polygon_cells")
        size = F.count(F.when(F.col("x1").isNotNull(), 1))
        crowded = staged(features.groupBy("ci", "cj").agg(size.alias("n")).filter(F.col("n") > crowd).select("ci", "cj"), "crowded_cells")
        done = level == levels or crowded.isEmpty()
        kept = features if done else features.join(crowded, ["ci", "cj"], "left_anti")
        out.append(kept.withColumn("level", F.lit(level)))
        used.append(level)
        if done:
            return staged(union_by_name(*out), "polygon_index"), used
        features = _halved(crowded, features, cell / 2.0**level)
    raise AssertionError("the last level is done")


def point_in_polygon(
    points: DataFrame,
    edges: DataFrame,
    cell: float = 0.5,
    id_cols: tuple[str, ...] = ("point_id",),
    x: str = "x",
    y: str = "y",
    crowd: int | None = None,
    levels: int = 10,
) -> DataFrame:
    """(ids, poly_id) for every polygon a point lies in or on the border of.

    ``edges`` holds closed rings as (poly_id, x1, y1, x2, y2); holes and several parts are rings of the
    same polygon. A point may be in several polygons. Rings must not cross the antimeridian.

    ``crowd`` bounds the edges that a point meets: cells with more are split, see ``polygon_index``. A point
    is then looked up once for each level in use. Without it all cells have one size.

    Give distinct points: for a grid over many scenarios, resolve its distinct cells once and reuse the
    result as a table. The cells of the edges are few and fixed, so Spark broadcasts them when small;
    otherwise adaptive execution splits a crowded cell. Parities are combined map-side before the final
    shuffle.
    """
    index, used = polygon_index(edges, cell, crowd, levels)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    places = [F.struct(F.lit(n).alias("level"), _cell(px, cell / 2.0**n).alias("ci"), _cell(py, cell / 2.0**n).alias("cj")) for n in used]
    if crowd is None:
        placed = points.select(*id_cols, px.alias("__px"), py.alias("__py"), F.lit(0).alias("level"), _cell(px, cell).alias("ci"), _cell(py, cell).alias("cj"))
        met = placed.join(index.drop("level"), ["ci", "cj"], "inner")
    else:
        placed = points.select(*id_cols, px.alias("__px"), py.alias("__py"), F.inline(F.array(*places)))
        met = placed.join(index, ["level", "ci", "cj"], "inner")

    e = _ends()
    p = (F.col("__px"), F.col("__py"))
    size = F.lit(cell) / F.pow(F.lit(2.0), F.col("level"))
    is_corner = F.col("x1").isNull()
    parity = F.when(is_corner, F.lit(1)).otherwise(_flip(e, p, (F.col("ci") * size, F.col("cj") * size)).cast("int"))
    cross = (p[1] - e[1]) * (e[2] - e[0]) - (p[0] - e[0]) * (e[3] - e[1])
    touches = (
        (cross == 0)
        & p[0].between(F.least(e[0], e[2]), F.greatest(e[0], e[2]))
        & p[1].between(e[1], e[3])
    )
    on_edge = F.when(is_corner, F.lit(False)).otherwise(touches)
    return (
        met.select(*id_cols, "poly_id", parity.alias("bit"), on_edge.alias("on_edge"))
        .groupBy(*id_cols, "poly_id")
        .agg(F.bit_xor("bit").alias("bit"), F.bool_or("on_edge").alias("on_edge"))
        .filter((F.col("bit") == 1) | F.col("on_edge"))
        .select(*id_cols, "poly_id")
    )
