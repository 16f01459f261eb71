"""The union of parts: against an arrangement in exact fractions, hand-made cases, and its plan."""

from __future__ import annotations

import random
import re
from fractions import Fraction as Q

import pytest

from fieldloom.operators import geo, overlay

SCHEMA = "k string, part string, ring int, seq int, x double, y double"


def layer(spark, shapes):
    """{key: {part: [ring, ...]}} with open rings."""
    rows = [
        (key, part, r + 1, s, float(x), float(y))
        for key, parts in shapes.items()
        for part, rings in parts.items()
        for r, ring in enumerate(rings)
        for s, (x, y) in enumerate([*ring, ring[0]], 1)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rings_of(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r.k, r.part, r.ring, r.seq)):
        out.setdefault((row.k, row.part, row.ring), []).append((row.x, row.y))
    for ring in out.values():
        assert ring[0] == ring[-1] and len(ring) > 3
    return out


def inside(point, rings):
    """Parity, for a point on no edge."""
    x, y = point
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def exact_union(parts):
    """Boundary pieces of the union, directed with the union to their left, straight runs joined."""
    parts = [[[(Q(x), Q(y)) for x, y in ring] for ring in rings] for rings in parts]
    lines = {frozenset((a, b)) for rings in parts for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)}
    lines = [tuple(sorted(line)) for line in lines]
    pieces = set()
    for a, b in lines:
        cuts = {a, b}
        for c, d in lines:
            r, s = (b[0] - a[0], b[1] - a[1]), (d[0] - c[0], d[1] - c[1])
            den = r[0] * s[1] - r[1] * s[0]
            if den:
                t = ((c[0] - a[0]) * s[1] - (c[1] - a[1]) * s[0]) / den
                u = ((c[0] - a[0]) * r[1] - (c[1] - a[1]) * r[0]) / den
                if 0 <= t <= 1 and 0 <= u <= 1:
                    cuts.add((a[0] + t * r[0], a[1] + t * r[1]))
            elif (c[0] - a[0]) * r[1] == (c[1] - a[1]) * r[0]:
                cuts |= {p for p in (c, d) if a <= p <= b}
        ordered = sorted(cuts)
        pieces |= set(zip(ordered, ordered[1:], strict=False))
    out = set()
    tiny = Q(1, 10**7)
    for a, b in pieces:
        mid, n = ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2), (a[1] - b[1], b[0] - a[0])
        left, right = (any(inside((mid[0] + sign * tiny * n[0], mid[1] + sign * tiny * n[1]), rings) for rings in parts) for sign in (1, -1))
        if left != right:
            out.add((a, b) if left else (b, a))
    return out


def area_of(edges):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in edges) / 2


def corners(edges):
    """Points where the direction changes."""
    ways = {}
    for a, b in edges:
        size = max(abs(b[0] - a[0]), abs(b[1] - a[1]))
        way = (round(float((b[0] - a[0]) / size), 6), round(float((b[1] - a[1]) / size), 6))
        ways.setdefault(a, []).append(("out", way))
        ways.setdefault(b, []).append(("in", way))
    return {
        (round(float(p[0]), 6), round(float(p[1]), 6))
        for p, w in ways.items()
        if not (len(w) == 2 and w[0][1] == w[1][1])
    }


def drawn(rings):
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:], strict=False)]


def check(spark, shapes, precision=9):
    got = rings_of(overlay.union_outlines(layer(spark, shapes), ["k"], precision))
    for key, parts in shapes.items():
        want = exact_union(list(parts.values()))
        mine = drawn([ring for (k, _, _), ring in got.items() if k == key])
        assert float(area_of(want)) == pytest.approx(area_of(mine), abs=1e-6)
        assert corners(want) == {(round(x, 6), round(y, 6)) for e in mine for x, y in e}
        for (k, _, ring), points in got.items():
            if k == key:
                assert (area_of(drawn([points])) > 0) == (ring == 1)
    return got


def square(x, y, w, h=None):
    h = w if h is None else h
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_hand_made_cases(spark):
    ring = [square(0, 0, 9), square(3, 3, 3)[::-1]]
    shapes = {
        "apart": {"a": [square(0, 0, 2)], "b": [square(5, 0, 2)]},
        "border": {"a": [square(0, 0, 2)], "b": [square(2, 0, 2)]},
        "part of a border": {"a": [square(0, 0, 4)], "b": [square(4, 1, 2)[::-1]], "c": [square(4, 3, 2)]},
        "overlap": {"a": [square(0, 0, 4)], "b": [square(2, 2, 4)]},
        "within": {"a": [square(0, 0, 9)], "b": [square(2, 2, 3)]},
        "same": {"a": [square(0, 0, 4)], "b": [square(0, 0, 4)], "c": [square(0, 0, 4)[::-1]]},
        "corner": {"a": [square(0, 0, 2)], "b": [square(2, 2, 2)]},
        "hole": {"a": ring},
        "hole filled": {"a": ring, "b": [square(3, 3, 3)]},
        "hole half filled": {"a": ring, "b": [square(3, 3, 2, 3)]},
        "hole overlapped": {"a": ring, "b": [square(2, 2, 2)]},
        "island": {"a": ring, "b": [square(4, 4, 1)]},
        "two holes meet": {"a": [square(0, 0, 9), square(1, 1, 4)], "b": [square(0, 0, 9), square(3, 3, 4)]},
        "around a gap": {"a": [square(0, 0, 6, 1)], "b": [square(0, 5, 6, 1)], "c": [square(0, 0, 1, 6)], "d": [square(5, 0, 1, 6)]},
    }
    got = check(spark, shapes)
    count = lambda key: (len({p for k, p, _ in got if k == key}), sum(k == key for k, _, _ in got))
    assert {key: count(key) for key in shapes} == {
        "apart": (2, 2), "border": (1, 1), "part of a border": (1, 1), "overlap": (1, 1), "within": (1, 1), "same": (1, 1),
        "corner": (2, 2), "hole": (1, 2), "hole filled": (1, 1), "hole half filled": (1, 2), "hole overlapped": (1, 2),
        "island": (2, 3), "two holes meet": (1, 2), "around a gap": (1, 2),
    }


def test_random_parts_against_exact_arrangement(spark):
    rng = random.Random(17)
    shapes = {}
    for k in range(8):
        parts = {}
        for p in range(rng.randint(2, 6)):
            if k % 2:
                x, y, w, h = rng.randint(0, 12), rng.randint(0, 12), rng.randint(3, 9), rng.randint(3, 9)
                rings = [square(x, y, w, h)]
                if w > 3 and h > 3 and rng.random() < 0.6:
                    rings.append(square(x + 1, y + 1, w - 2, h - 2)[:: rng.choice([1, -1])])
            else:
                while True:
                    ring = [(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(3)]
                    (ax, ay), (bx, by), (cx, cy) = ring
                    if (bx - ax) * (cy - ay) != (by - ay) * (cx - ax):
                        break
                rings = [ring]
            parts[f"p{p}"] = rings
        shapes[f"k{k}"] = parts
    check(spark, shapes)


def test_membership_and_crowded_cells(spark, monkeypatch):
    """Cells cut again and again; points are in the union exactly when they are in a part."""
    monkeypatch.setattr(overlay, "CROWD", 4)
    rng = random.Random(3)
    shapes = {"k": {f"p{i}": [square(rng.randint(0, 20), rng.randint(0, 20), 5)] for i in range(12)} | {"far": [square(900, 900, 50)]}}
    vertices = layer(spark, shapes)
    union = overlay.union_outlines(vertices, ["k"])
    points = spark.createDataFrame([(i, rng.randint(0, 260) / 10 + 0.05, rng.randint(0, 260) / 10 + 0.05) for i in range(400)], "id int, x double, y double")
    a, b = (sorted(r.id for r in geo.points_in_polygons(points, v, ["k"]).select("id").distinct().collect()) for v in (vertices, union))
    assert a == b and 0 < len(a) < 400


def test_a_long_outline_is_dealt_out(spark):
    """Two combs of many teeth across each other: the plan has no exchange by key alone."""
    teeth = 60
    comb = [(0, 0), *[(x, y) for i in range(teeth) for x, y in ((2 * i, 40), (2 * i + 1, 40), (2 * i + 1, 1), (2 * i + 2, 1))], (2 * teeth, 0)]
    shapes = {"k": {"a": [comb], "b": [square(-5, 10, 2 * teeth + 10, 5)]}}
    got = check(spark, shapes)
    assert len({p for _, p, _ in got}) == 1
    plans = []
    overlay.union_outlines(
        layer(spark, shapes), ["k"], keep=lambda _n, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df.checkpoint()
    )
    windows = re.findall(r"windowspecdefinition\((.*?) (?:ASC|DESC)", "\n".join(plans))
    # a window runs over the points of one segment, or one stretch of a ring, never over a key's edges
    assert windows and all(w.count(",") >= 2 for w in windows)
    assert not any(bad in plan for plan in plans for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "MapInPandas"))


def test_empty_layer(spark):
    assert overlay.union_outlines(spark.createDataFrame([], SCHEMA), ["k"]).count() == 0
