"""Reference systems, projection, polygons within a distance, distinct sums."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import projection
from fieldloom.operators import editions, geo


def test_the_system_stays_with_the_coordinates(spark, tmp_path):
    points = geo.with_srid(spark.createDataFrame([(1, 2.0, 3.0)], "id int, x double, y double"), 4283)
    assert geo.srid_of(points) == geo.srid_of(points.select("y", "x").where("x > 0")) == 4283
    points.write.parquet(str(tmp_path / "p"))
    assert geo.srid_of(spark.read.parquet(str(tmp_path / "p"))) == 4283
    assert geo.srid_of(spark.createDataFrame([(1.0, 2.0)], "x double, y double")) is None


def test_different_systems_do_not_meet(spark):
    square = [(1, 1, 1, s, float(x), float(y)) for s, (x, y) in enumerate([(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], 1)]
    layer = spark.createDataFrame(square, "k int, part int, ring int, seq int, x double, y double")
    points = spark.createDataFrame([(1, 2.0, 3.0)], "id int, x double, y double")
    joins = (
        lambda p, v: geo.points_in_polygons(p, v, ["k"]),
        lambda p, v: geo.nearest_polygon(p, v, "id", "k"),
        lambda p, v: geo.polygons_within(p, v, "id", "k", 1.0),
    )
    for join in joins:
        with pytest.raises(geo.DifferentSrid, match="3112"):
            join(geo.with_srid(points, 4283), geo.with_srid(layer, 3112))
        # the same system, or one that is not told
        assert join(geo.with_srid(points, 4283), geo.with_srid(layer, 4283)).count() == join(points, layer).count() == 1
    named = editions.point_from_lonlat(spark.createDataFrame([(150.0, -30.0)], "lon double, lat double"))
    assert geo.srid_of(named) == 4283 and named.first().srid == 4283


def projected(spark, cone, points):
    df = spark.createDataFrame(points, "lon double, lat double")
    x, y = cone.project(F.col("lon"), F.col("lat"))
    return [tuple(r) for r in df.select(x, y).collect()]


def test_published_point(spark):
    """The worked example of the EPSG guidance note for this method: NAD27 / Texas South Central, in US survey feet."""
    texas = projection.LambertCone(
        a=20925832.16, f=294.97870, lat1=28 + 23 / 60, lat2=30 + 17 / 60, lat0=27 + 50 / 60, lon0=-99.0, x0=2000000.0, y0=0.0
    )
    (x, y), = projected(spark, texas, [(-96.0, 28.5)])
    assert (round(x, 2), round(y, 2)) == (2963503.91, 254759.80)


def test_true_to_scale_on_the_standard_parallels(spark):
    """A degree of longitude is as long on the map as on the ellipsoid, and angles are kept elsewhere."""
    cone = projection.CONES[3112]
    d = 1e-5
    for lat in (-18.0, -36.0, -27.0, -43.5):
        (x0, y0), (x1, y1), (x2, y2) = projected(spark, cone, [(147.0, lat), (147.0 + d, lat), (147.0, lat + d)])
        phi, e2 = math.radians(lat), cone.e**2
        east = cone.a * math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2) * math.radians(d)
        north = cone.a * (1 - e2) / (1 - e2 * math.sin(phi) ** 2) ** 1.5 * math.radians(d)
        k = math.hypot(x1 - x0, y1 - y0) / east
        assert k == pytest.approx(math.hypot(x2 - x0, y2 - y0) / north, rel=1e-5)
        assert k == pytest.approx(1, abs=1e-6) if lat in (-18.0, -36.0) else abs(k - 1) > 1e-3
    assert projected(spark, cone, [(134.0, 0.0)]) == [(0.0, 0.0)]


def test_there_and_back(spark):
    rng = random.Random(2)
    rows = [(i, rng.uniform(110, 156), rng.uniform(-45, -8)) for i in range(200)]
    points = geo.with_srid(spark.createDataFrame(rows, "id int, x double, y double"), 4283)
    there = projection.transform(points, 3112)
    assert geo.srid_of(there) == 3112
    for r in projection.transform(there, 4283).collect():
        assert (r.x, r.y) == pytest.approx(rows[r.id][1:], abs=1e-9)
    assert projection.transform(points, 4283).collect() == points.collect()
    with pytest.raises(ValueError, match="4326"):
        projection.transform(points, 4326)
    with pytest.raises(ValueError, match="not 3112"):
        projection.transform(points, 4283, source=3112)
    with pytest.raises(ValueError, match="None"):
        projection.transform(points.select("id", (F.col("x") + 0).alias("x"), (F.col("y") + 0).alias("y")), 3112)


def to_edge(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


@pytest.mark.parametrize("distance", [-1.0, 0.0, 0.01, 0.7, 5.0, 60.0, 1e4])
def test_polygons_within_a_distance_against_brute_force(spark, distance):
    rng = random.Random(9)
    shapes = {}
    for k in range(12):
        x, y, w = rng.uniform(0, 50), rng.uniform(0, 50), rng.choice([0.2, 1, 6])
        # flat and steep ones too, and a square hole in the large
        shapes[k] = [[(x, y), (x + 4 * w, y + w / 3), (x + 5 * w, y + 3 * w), (x + w / 2, y + 2 * w)]]
        if w == 6:
            shapes[k].append([(x + 8, y + 6), (x + 10, y + 6), (x + 10, y + 8), (x + 8, y + 8)])
    points = {i: (rng.uniform(-20, 90), rng.uniform(-20, 90)) for i in range(150)} | {150: shapes[0][0][0]}
    vertices = [
        (k, 1, r + 1, s, *p) for k, rings in shapes.items() for r, ring in enumerate(rings) for s, p in enumerate([*ring, ring[0]], 1)
    ]
    layer = spark.createDataFrame(vertices, "k int, part int, ring int, seq int, x double, y double")
    frame = spark.createDataFrame([(i, *p) for i, p in points.items()], "id int, x double, y double")
    got = {(r.id, r.k): r.distance for r in geo.polygons_within(frame, layer, "id", "k", distance).collect()}
    want = {}
    for i, p in points.items():
        for k, rings in shapes.items():
            lines = [(a, b) for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
            crossed = sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in lines)
            d = 0.0 if crossed % 2 else min(to_edge(p, a, b) for a, b in lines)
            if d <= distance:
                want[i, k] = d
    assert got.keys() == want.keys()
    assert all(got[key] == pytest.approx(want[key], abs=1e-9) for key in want)
    assert bool(want) == (distance >= 0) and (distance < 1e4 or len(want) == 151 * 12)


def test_distinct_sums(spark):
    rows = [("a", 1, 5), ("a", 1, 5), ("a", 1, 2), ("a", 2, 5), ("a", 1, None), ("b", 2, None), ("c", 3, 4)]
    df = editions.distinct_sighting_sums(spark.createDataFrame(rows, "taxon_id string, survey_type_id int, num_sightings long"))
    assert {tuple(r) for r in df.collect()} == {("a", 7, 5), ("b", None, None), ("c", None, None)}
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
