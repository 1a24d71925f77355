import math
import random

import pytest
from hypothesis import given, settings, strategies as st

from scenlens.operators.spatial import point_in_polygon

EDGES = "poly_id int, x1 double, y1 double, x2 double, y2 double"


def ring(poly_id, corners):
    return [
        (poly_id, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
        for a, b in zip(corners, corners[1:] + corners[:1])
    ]


def brute(points, edges):
    out = set()
    for pid, px, py in points:
        inside, touching = {}, set()
        for poly, x1, y1, x2, y2 in edges:
            if y1 > y2:
                x1, y1, x2, y2 = x2, y2, x1, y1
            cross = (py - y1) * (x2 - x1) - (px - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and y1 <= py <= y2:
                touching.add(poly)
            if y1 <= py < y2 and cross < 0:
                inside[poly] = not inside.get(poly, False)
        out |= {(pid, poly) for poly, odd in inside.items() if odd} | {(pid, q) for q in touching}
    return out


def run(spark, points, edges, cell, crowd=None):
    p = spark.createDataFrame(points, "point_id int, x double, y double")
    e = spark.createDataFrame(edges, EDGES)
    rows = point_in_polygon(p, e, cell, crowd=crowd).collect()
    got = [(r.point_id, r.poly_id) for r in rows]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("cell", [0.25, 0.5, 1.0, 3.0, 50.0])
def test_lattice_points_vertices_and_borders(spark, cell):
    """Points on vertices, on edges and on cell borders, where ray casts usually go wrong."""
    edges = (
        ring(1, [(0, 0), (4, 0), (2, 3)])
        + ring(2, [(1, 1), (5, 1), (5, 4), (1, 4)])
        + ring(3, [(3, 2), (6, 2), (6, 5), (3, 5)])
        + ring(4, [(-4, -4), (-1, -4), (-1, -1), (-4, -1)])
        + ring(4, [(-3, -3), (-2, -3), (-2, -2), (-3, -2)])  # a hole
    )
    points = [
        (i * 100 + j, -5 + i * 0.25, -5 + j * 0.25) for i in range(48) for j in range(44)
    ]
    assert run(spark, points, edges, cell) == brute(points, edges)


def test_many_sided_polygons(spark):
    rnd = random.Random(7)
    edges = []
    for poly in range(12):
        cx, cy, n = rnd.uniform(-40, 40), rnd.uniform(-40, 40), rnd.randint(3, 200)
        corners = []
        for k in range(n):
            r = rnd.uniform(2, 15)
            a = 2 * math.pi * k / n
            corners.append((round(cx + r * math.cos(a), 2), round(cy + r * math.sin(a), 2)))
        edges += ring(poly, corners)
    points = [(i, round(rnd.uniform(-60, 60), 1), round(rnd.uniform(-60, 60), 1)) for i in range(3000)]
    want = brute(points, edges)
    assert len(want) > 300
    for cell in (0.7, 5.0):
        assert run(spark, points, edges, cell) == want


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6)), min_size=3, max_size=9),
    st.sampled_from([0.1, 0.3, 1.0, 2.5]),
)
def test_any_closed_ring(spark, corners, cell):
    """Also self-crossing and degenerate rings: the identity only needs closure."""
    edges = ring(1, corners)
    points = [(i * 100 + j, -7 + i * 0.7, -7 + j * 0.5) for i in range(21) for j in range(29)]
    assert run(spark, points, edges, cell) == brute(points, edges)


def comb(poly_id, n, x0=0.0, width=1.0):
    """A ring whose lower side has n teeth in a narrow stretch."""
    teeth = [(x0 + width * i / n, 0.5 * (i % 2)) for i in range(n)]
    return ring(poly_id, [*teeth, (x0 + width, -1.0), (30.0, -1.0), (30.0, 30.0), (-5.0, 30.0), (-5.0, 0.0)])


@pytest.mark.parametrize("crowd", [2, 20])
def test_split_cells_give_the_same(spark, crowd):
    """Lattice points on vertices, edges and the borders of cells of all levels; a hole, and an edge there and back."""
    keyhole = ring(5, [(0, 0), (8, 0), (8, 8), (0, 8), (0, 4), (2, 4), (2, 2), (6, 2), (6, 6), (2, 6), (2, 4), (0, 4)])
    edges = (
        ring(1, [(0, 0), (4, 0), (2, 3)]) + ring(2, [(1, 1), (5, 1), (5, 4), (1, 4)]) + keyhole
        + ring(4, [(-4, -4), (-1, -4), (-1, -1), (-4, -1)]) + ring(4, [(-3, -3), (-2, -3), (-2, -2), (-3, -2)])
    )
    points = [(i * 100 + j, -4.5 + i * 0.25, -4.5 + j * 0.25) for i in range(54) for j in range(54)]
    assert run(spark, points, edges, 4.0, crowd) == brute(points, edges)


def test_a_detailed_ring_is_split_where_it_is_detailed(spark):
    """Two thousand teeth in one unit: cells of one size meet them all, the index meets few, with equal results."""
    from pyspark.sql import functions as F
    from scenlens.operators.spatial import polygon_index

    edges = comb(1, 2000) + ring(2, [(-3, -3), (20, -3), (20, 20), (-3, 20)])
    rng = random.Random(5)
    points = [(i, rng.uniform(-6, 31), rng.uniform(-2, 31)) for i in range(300)] + [(300 + i, rng.uniform(0, 1), rng.uniform(-0.2, 0.7)) for i in range(300)]
    want = brute(points, edges)
    assert run(spark, points, edges, 2.0) == want and run(spark, points, edges, 2.0, 40) == want
    table = spark.createDataFrame(edges, EDGES)

    def most(index):
        return index.filter("x1 is not null").groupBy("level", "ci", "cj").count().agg(F.max("count")).first()[0]

    one, _ = polygon_index(table, 2.0)
    index, used = polygon_index(table, 2.0, 40)
    assert most(one) > 1900 and most(index) <= 40 and len(used) > 4
    cells = index.select("level", "ci", "cj").distinct().count()
    assert cells < 5000  # a fine grid of the least size would have far more
    places = index.select("level", "ci", "cj").distinct().collect()
    assert not {(c.level, c.ci, c.cj) for c in places} & {(c.level - 1, c.ci // 2, c.cj // 2) for c in places}


def test_depth_ends_where_edges_share_a_vertex(spark):
    edges = [e for i in range(40) for e in ring(i, [(0, 0), (math.cos(i), math.sin(i)), (math.cos(i + 0.3), math.sin(i + 0.3))])]
    rng = random.Random(2)
    points = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(200)] + [(200, 0.0, 0.0)]
    assert run(spark, points, edges, 1.0, 10) == brute(points, edges)
