"""Polygon joins against brute force over exact arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from fieldloom.operators import geo, regions, taxa
from fieldloom.operators.simplify import simplify_rings

VERTEX = "id int, part int, ring int, seq int, x double, y double"


def layer(spark, polygons):
    """polygons: {id: [part: [ring: [(x, y), ...] not closed]]}"""
    rows = [
        (key, p, r, s, float(x), float(y))
        for key, parts in polygons.items()
        for p, rings in enumerate(parts, 1)
        for r, ring in enumerate(rings, 1)
        for s, (x, y) in enumerate([*ring, ring[0]], 1)
    ]
    return spark.createDataFrame(rows, VERTEX)


def points(spark, coordinates):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(coordinates)], "p int, x double, y double")


def inside(rings, x, y) -> bool:
    x, y = Fraction(x), Fraction(y)
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
            side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 <= y < y2 and side > 0) or (y2 <= y < y1 and side < 0):
                odd = not odd
    return odd


def found_in(spark, vertices, coordinates):
    return [(r.p, r.id) for r in geo.points_in_polygons(points(spark, coordinates), vertices, ["id"]).collect()]


def found(spark, polygons, coordinates):
    return found_in(spark, layer(spark, polygons), coordinates)


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]
HOLE = [(1, 1), (3, 1), (3, 3), (1, 3)]
DIAMOND = [(0, -2), (2, 0), (0, 2), (-2, 0)]


def test_boundary_counts(spark):
    places = [(1, 1), (-1, 1), (-1, -1), (1, -1), (0, 2), (2, 0), (0, -2), (-2, 0), (0, 0), (1.5, 1), (-2, 1), (3, 0), (2, 2)]
    got = {p for p, _ in found(spark, {1: [[DIAMOND]]}, places)}
    assert got == set(range(9))


def test_level_with_a_vertex(spark):
    # rays that run through a vertex, along a horizontal edge, and past a spike
    shape = [(0, 0), (6, 0), (6, 4), (4, 4), (3, 2), (2, 4), (0, 4)]
    places = [(1, 2), (3, 2), (5, 2), (-1, 2), (-1, 4), (3, 3), (3, 4), (1, 4), (7, 0), (-1, 0)]
    got = {p for p, _ in found(spark, {1: [[shape]]}, places)}
    assert got == {i for i, (x, y) in enumerate(places) if inside([shape], x, y)}


def test_hole_and_its_border(spark):
    got = {p for p, _ in found(spark, {1: [[SQUARE, HOLE]]}, [(2, 2), (0.5, 0.5), (1, 2), (3.5, 3.5), (5, 5)])}
    assert got == {1, 2, 3}


def test_parts_and_shared_point(spark):
    second = [(x + 10, y) for x, y in SQUARE]
    overlapping = [(x + 2, y) for x, y in SQUARE]
    assert set(found(spark, {1: [[SQUARE], [second]]}, [(1, 1), (11, 1), (7, 1)])) == {(0, 1), (1, 1)}
    # one row per part that covers the point
    assert found(spark, {1: [[SQUARE], [overlapping]]}, [(3, 1)]) == [(0, 1), (0, 1)]


def star(rng, corners, radius, cx, cy):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    grid = 64
    return [
        (
            round((cx + radius * rng.uniform(0.3, 1) * math.cos(a)) * grid) / grid,
            round((cy + radius * rng.uniform(0.3, 1) * math.sin(a)) * grid) / grid,
        )
        for a in angles
    ]


def test_an_outline_of_many_vertices(spark):
    """Most vertices of the layer in one wavy ring: finer cells, the same answer."""
    n = 8000
    wave = [
        ((1000 + 40 * math.sin(37 * a)) * math.cos(a), (1000 + 40 * math.sin(37 * a)) * math.sin(a))
        for a in (2 * math.pi * i / n for i in range(n))
    ]
    shapes = layer(spark, {1: [[wave]], 2: [[SQUARE]]})
    cells = geo.polygon_cells(shapes, ["id"]).where("id = 1")
    assert cells.count() <= n
    assert cells.selectExpr("max(size(segs))").first()[0] < n / 4
    rng = random.Random(3)
    places = [(rng.uniform(-1100, 1100), rng.uniform(-1100, 1100)) for _ in range(400)]
    got = {p for p, key in found_in(spark, shapes, places) if key == 1}
    want = set()
    for p, (x, y) in enumerate(places):
        a, r = math.atan2(y, x), math.hypot(x, y)
        edge = 1000 + 40 * math.sin(37 * a)
        assert abs(r - edge) > 1e-3
        if r < edge:
            want.add(p)
    assert got == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force_on_mixed_sizes(spark, seed):
    """Tiny, middle and very wide shapes in one layer; points on corners, edges and anywhere."""
    rng = random.Random(seed)
    polygons = {}
    for i in range(14):
        radius = 4.0 ** rng.uniform(-1.5, 4)
        polygons[i] = [[star(rng, rng.randint(3, 40), radius, rng.uniform(-50, 50), rng.uniform(-50, 50))]]
    places = [(rng.uniform(-120, 120), rng.uniform(-120, 120)) for _ in range(150)]
    for parts in polygons.values():
        ring = parts[0][0]
        places += rng.sample(ring, min(4, len(ring)))
        (x1, y1), (x2, y2) = ring[0], ring[1]
        places.append(((x1 + x2) / 2, (y1 + y2) / 2))
    want = {(p, k) for p, (x, y) in enumerate(places) for k, parts in polygons.items() if inside(parts[0], x, y)}
    got = found(spark, polygons, places)
    assert len(got) == len(set(got))
    assert set(got) == want


def test_a_place_shared_by_most_points(spark):
    crowd = spark.range(20000).selectExpr(
        "CAST(id AS INT) AS p", "CASE WHEN id % 3 < 2 THEN 1D ELSE CAST(id % 9 AS DOUBLE) END AS x", "1D AS y"
    )
    rows = geo.points_in_polygons(crowd, layer(spark, {1: [[SQUARE]], 2: [[DIAMOND]]}), ["id"]).groupBy("id").count()
    want = {1: crowd.where("x <= 4").count(), 2: crowd.where("x <= 1").count()}
    assert {r.id: r["count"] for r in rows.collect()} == want


def test_centroids(spark):
    far = [(150 + x * 1e-4, -30 + y * 1e-4) for x, y in SQUARE]
    shapes = {
        1: [[SQUARE]],
        2: [[list(reversed(SQUARE)), HOLE]],  # wound the other way, with a hole in the middle
        3: [[SQUARE, [(0, 0), (2, 0), (2, 4), (0, 4)]]],  # the left half cut out
        4: [[SQUARE], [[(10 + x, y) for x, y in SQUARE]]],  # two parts
        5: [[far]],
        6: [[[(0, 0), (4, 0)]]],  # no area
        7: [[[(3, 5)]]],  # a point
    }
    got = {r.id: (r.x, r.y) for r in geo.centroids(layer(spark, shapes), ["id"]).collect()}
    want = {1: (2, 2), 2: (2, 2), 3: (3, 2), 4: (7, 2), 5: (150.0002, -29.9998), 6: (2, 0), 7: (3, 5)}
    assert set(got) == set(want)
    for key, (x, y) in want.items():
        assert got[key] == pytest.approx((x, y), abs=1e-12), key


def segment_distance(x1, y1, x2, y2, x, y):
    dx, dy = x2 - x1, y2 - y1
    t = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
    return math.hypot(x - x1 - t * dx, y - y1 - t * dy)


@pytest.mark.parametrize("seed", [5, 6])
def test_nearest_equals_brute_force(spark, seed):
    """Near misses, far points and long slanted edges."""
    rng = random.Random(seed)
    polygons = {i: [[star(rng, 12, 4.0 ** rng.uniform(-2, 2), rng.uniform(-40, 40), rng.uniform(-40, 40))]] for i in range(9)}
    polygons[20] = [[[(-90, -90), (90, -80), (90, -81)]]]
    places = [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(60)]
    places += [(1e5, 3.0), (-7e8, 2e8), (0.0, -85 + 1e-7)]
    rows = geo.nearest_polygon(points(spark, places), layer(spark, polygons), "p", "id").collect()
    assert len(rows) == len(places)
    for row in rows:
        x, y = places[row.p]
        best = min(
            (segment_distance(*a, *b, x, y), key)
            for key, parts in polygons.items()
            for a, b in zip(parts[0][0], [*parts[0][0][1:], parts[0][0][0]])
        )
        assert row.distance == pytest.approx(best[0], rel=1e-9, abs=1e-12)
        assert row.id == best[1]


def test_sites_of_a_two_part_range_appear_once(spark):
    ranges = layer(spark, {1: [[SQUARE], [[(x + 2, y) for x, y in SQUARE]]]}).selectExpr(
        "id AS sp_id", "'t' AS taxon_id", "1 AS range_id", "part", "ring", "seq", "x", "y"
    )
    centres = spark.createDataFrame([(7, 1, 3.0, 1.0)], "site_id int, site_type int, x double, y double")
    assert taxa.sites_in_ranges(centres, ranges).count() == 1


def test_region_on_a_shared_border(spark):
    vertex = layer(spark, {1: [[SQUARE]], 2: [[[(x + 4, y) for x, y in SQUARE]]]}).withColumnRenamed("id", "region_id")
    names = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "region_id int, region_name string, region_code string")
    centres = spark.createDataFrame([(7, 4.0, 1.0)], "site_id int, x double, y double")
    assert regions.site_region(centres, names, vertex).count() == 2
    assert [r.region_id for r in regions.site_region(centres, names, vertex, pick="min").collect()] == [1]


def reference_simplify(ring, tolerance):
    """Recursive form, over a closed ring."""

    def inner(line):
        if len(line) < 3:
            return line
        distances = [segment_distance(*line[0], *line[-1], *p) for p in line[1:-1]]
        top = max(distances)
        if top <= tolerance:
            return [line[0], line[-1]]
        cut = distances.index(top) + 1
        return inner(line[: cut + 1])[:-1] + inner(line[cut:])

    return inner(ring)


@pytest.mark.parametrize("longest", [200_000, 7])
def test_simplify(spark, longest):
    """The same rings come out whether a segment is finished in one task or split over rounds first."""
    rng = random.Random(11)
    shapes = {i: [[star(rng, rng.randint(8, 60), 10, 0, 0)]] for i in range(6)}
    shapes[9] = [[[(0, 0), (0.01, 0), (0.01, 0.01)]]]  # collapses
    got = simplify_rings(layer(spark, shapes), ["id"], 1.5, longest).orderBy("id", "seq").collect()
    for key, parts in shapes.items():
        closed = [*parts[0][0], parts[0][0][0]]
        want = reference_simplify([(float(x), float(y)) for x, y in closed], 1.5)
        mine = [r for r in got if r.id == key]
        if len(want) < 4:
            assert not mine
            continue
        assert [(r.x, r.y) for r in mine] == want
        assert [r.seq for r in mine] == list(range(1, len(want) + 1))


def test_simplify_off(spark):
    shapes = layer(spark, {1: [[SQUARE]]})
    assert simplify_rings(shapes, ["id"], 0).count() == 5


@pytest.mark.parametrize("longest", [3, 10, 57])
def test_long_and_short_segments_agree_on_random_doubles(spark, longest):
    """Both ways of judging a vertex use the same arithmetic: ties and bits do not hang on the size of a segment."""
    rng = np.random.default_rng(longest)
    shapes = []
    for key in range(4):
        n = 120
        turn = np.sort(rng.uniform(0, 2 * np.pi, n))
        radius = np.where(rng.uniform(size=n) < 0.5, 10.0, rng.uniform(8, 12, n))
        ring = [(float(r * np.cos(t)), float(r * np.sin(t))) for r, t in zip(radius, turn, strict=True)]
        shapes += [(key, 0, 1, i, x, y) for i, (x, y) in enumerate([*ring, ring[0]])]
    vertices = spark.createDataFrame(shapes, "id long, part int, ring int, seq int, x double, y double")
    whole = {tuple(r) for r in simplify_rings(vertices, ["id"], 0.7, 10**6).collect()}
    assert {tuple(r) for r in simplify_rings(vertices, ["id"], 0.7, longest).collect()} == whole
    assert 16 < len(whole) < len(shapes)


def test_a_flat_zigzag_does_not_gather_its_edges(spark):
    """1000 wide, 1 high: rows of cells as fine as the height, and no cell carries all edges to its right."""
    n = 2000
    up = [(i * 0.5, float(i % 2)) for i in range(n)]
    ring = [*up, (1000.0, 2.0), (-1.0, 2.0), up[0]]
    vertices = spark.createDataFrame(
        [(1, 0, 1, i, float(x), float(y)) for i, (x, y) in enumerate(ring)], "id int, part int, ring int, seq int, x double, y double"
    )
    cells = geo.polygon_cells(vertices, ["id"])
    assert cells.selectExpr("max(size(segs))").first()[0] < n / 4
    points = [(i, 0.2501 + 3.7 * i, 0.137 + (i % 19) / 10) for i in range(260)]
    got = {r.pid for r in geo.points_in_polygons(spark.createDataFrame(points, "pid int, x double, y double"), vertices, ["id"]).collect()}

    def inside(x, y):
        crossed = sum(((y1 <= y) != (y2 <= y)) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False))
        return crossed % 2 == 1

    assert got == {i for i, x, y in points if inside(x, y)}


def test_outlines_are_dealt_by_row_and_block(spark):
    vertices = spark.createDataFrame([(1, 0, 1, 0, 0.0, 0.0)], "id int, part int, ring int, seq int, x double, y double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = geo.polygon_cells(vertices, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any("hashpartitioning" in line and "cy#" in line and "block#" in line for line in plan.splitlines())


def test_nearest_far_points_and_a_long_edge(spark):
    """Points far outside the layer, beside one edge of forty degrees and many short ones."""
    rng = np.random.default_rng(3)
    shapes = [(0, [(0.0, 0.0), (40.0, 0.0), (40.0, 0.5), (0.0, 0.5)])]
    for key in range(1, 40):
        x, y = rng.uniform(0, 40), rng.uniform(5, 20)
        shapes.append((key, [(x, y), (x + 0.1, y), (x + 0.1, y + 0.1), (x, y + 0.1)]))
    rows, lines = [], []
    for key, ring in shapes:
        closed = [*ring, ring[0]]
        rows += [(key, 0, 1, i, float(x), float(y)) for i, (x, y) in enumerate(closed)]
        lines += [(key, a, b) for a, b in zip(closed, closed[1:], strict=False)]
    vertices = spark.createDataFrame(rows, "region_id int, part int, ring int, seq int, x double, y double")
    points = [(i, float(rng.uniform(-500, 500)), float(rng.uniform(-500, 500))) for i in range(60)]
    points += [(60 + i, float(x), float(rng.uniform(1, 4))) for i, x in enumerate(rng.uniform(0, 40, 40))]

    def distance(p, a, b):
        p, a, b = np.array(p), np.array(a), np.array(b)
        t = np.clip((p - a) @ (b - a) / ((b - a) @ (b - a)), 0, 1)
        return float(np.hypot(*(p - a - t * (b - a))))

    found = geo.nearest_polygon(spark.createDataFrame(points, "pid int, x double, y double"), vertices, "pid", "region_id").collect()
    assert len(found) == len(points)
    for r in found:
        _, x, y = points[r.pid]
        best = min((distance((x, y), a, b), key) for key, a, b in lines)
        assert abs(r.distance - best[0]) < 1e-9 and r.region_id == best[1]
