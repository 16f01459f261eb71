"""The union of overlapping polygon parts, as outlines.

An arrangement of the outlines' edges, worked out by cells: edges are split where they
meet, every fragment is told which parts lie on either side of it, and those with a part
on exactly one side are linked into rings.  Every step is a join or an aggregate by
fragment, cell or vertex; no step gathers a polygon or a ring in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldloom.functions import geometry as g
from fieldloom.operators import geo
from fieldloom.session import cut_lineage

Keep = Callable[[str, DataFrame], DataFrame]

_ENDS = ["x1", "y1", "x2", "y2"]
#: Edges of a cell that are compared with each other; fuller cells are cut into 16.
CROWD = 256
#: How often a cell is cut: beyond, its edges meet in one point.
CUTS = 8
_STRETCH = 1000


def _struct(columns: Sequence[str], prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in columns])


def _upward(first: str = "x1, y1", second: str = "x2, y2") -> Column:
    return F.expr(f"struct({first}) < struct({second})")


def _canonical(df: DataFrame, way: Column) -> DataFrame:
    """Edges from their lower end to the higher one; ``way`` is 1 or -1 as the edge ran before, times the one given."""
    swap = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    up = _upward()
    ends = [F.when(up, F.col(c)).otherwise(F.col(swap[c])).alias(c) for c in _ENDS]
    return df.select(*[c for c in df.columns if c not in (*_ENDS, "way")], *ends, F.when(up, way).otherwise(-way).alias("way"))


def _oriented(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges that have the part to their left: keys, part, x1, y1, x2, y2.  Rings without area fall away."""
    ring = [*keys, "part", "ring"]
    lines = geo.edges(vertices, keys).where("x1 <> x2 OR y1 <> y2")
    origin = vertices.groupBy(*ring).agg(F.min("x").alias("ox"), F.min("y").alias("oy"))
    cross = "(x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy)"
    areas = (
        lines.join(origin, ring)
        .groupBy(*ring, F.expr(f"seq div {_STRETCH}").alias("stretch")).agg(F.sum(F.expr(cross)).alias("area"))
        .groupBy(*ring).agg(F.sum("area").alias("area"))
    )
    # a shell runs to the left around its part, a hole to the right
    kept = F.expr("area > 0 = (ring = 1)")
    swap = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    return lines.join(areas.where("area <> 0"), ring).select(
        *keys, "part", *[F.when(kept, F.col(c)).otherwise(F.col(swap[c])).alias(c) for c in _ENDS]
    )


def _in_cells(segments: DataFrame, keys: Sequence[str], tolerance: float, keep: Keep) -> DataFrame:
    """The segments in the cells that they pass, cells with many segments cut until few are left in each."""
    extent = "greatest(max(x2) - min(x1), max(greatest(y1, y2)) - min(least(y1, y2)))"
    side = f"greatest({extent} / sqrt(count(x1)), {64 * tolerance!r}D)"
    levels = segments.groupBy(*keys).agg(F.expr(f"CAST(ceil(log2({side}) / 2) AS INT)").alias("level"))
    cell = [*keys, "level", "cx", "cy"]
    now, settled = geo.passed_cells(segments.join(levels, list(keys)), tolerance), []
    for cut in range(CUTS + 1):
        now = keep(f"union_cells_{cut}", now)
        crowded = now.groupBy(*cell).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).drop("n")
        if cut == CUTS or crowded.isEmpty():
            settled.append(now)
            break
        settled.append(now.join(crowded, cell, "left_anti"))
        inner = now.join(crowded, cell, "left_semi").select(
            *keys, *_ENDS, (F.col("level") - 1).alias("level"), F.col("cx").alias("ux"), F.col("cy").alias("uy")
        )
        now = geo.passed_cells(inner, tolerance).where("floor(cx / 4) = ux AND floor(cy / 4) = uy").drop("ux", "uy")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _split_points(cells: DataFrame, keys: Sequence[str], precision: int, tolerance: float) -> DataFrame:
    """Where segments are to be split: keys, x1, y1, x2, y2, x, y.

    That is at the ends of others within the tolerance, and where two cross.  Both
    segments of a pair get the crossing from the same arithmetic, so they share its bits.
    """
    cell = [*keys, "level", "cx", "cy"]
    sides = [cells.select(*cell, _struct(_ENDS).alias(name)) for name in ("p", "q")]
    reach = (
        f"p < q AND p.x1 <= q.x2 + {tolerance!r}D AND q.x1 <= p.x2 + {tolerance!r}D"
        f" AND least(p.y1, p.y2) <= greatest(q.y1, q.y2) + {tolerance!r}D"
        f" AND least(q.y1, q.y2) <= greatest(p.y1, p.y2) + {tolerance!r}D"
    )
    pairs = sides[0].join(sides[1], cell).where(reach).select(*keys, "p", "q").distinct()

    def near(segment: str, other: str, end: int) -> Column:
        x, y = F.col(f"{other}.x{end}"), F.col(f"{other}.y{end}")
        at = [F.col(f"{segment}.{c}") for c in _ENDS]
        close = g.squared_distance_to_edge(*at, x, y) <= tolerance * tolerance
        own = ((x == at[0]) & (y == at[1])) | ((x == at[2]) & (y == at[3]))
        return F.when(close & ~own, F.struct(x.alias("x"), y.alias("y")))

    def turn(segment: str, other: str, end: int) -> str:
        return (
            f"(({segment}.x2 - {segment}.x1) * ({other}.y{end} - {segment}.y1)"
            f" - ({segment}.y2 - {segment}.y1) * ({other}.x{end} - {segment}.x1))"
        )

    ends = {(s, o, n): near(s, o, n) for s, o in (("p", "q"), ("q", "p")) for n in (1, 2)}
    named = pairs.select("*", *[value.alias(f"{s}{n}") for (s, _, n), value in ends.items()])
    crosses = F.expr(
        f"p1 IS NULL AND p2 IS NULL AND q1 IS NULL AND q2 IS NULL AND signum({turn('p', 'q', 1)}) * signum({turn('p', 'q', 2)}) = -1"
        f" AND signum({turn('q', 'p', 1)}) * signum({turn('q', 'p', 2)}) = -1"
    )
    along = f"try_divide({turn('q', 'p', 1)}, {turn('q', 'p', 1)} - {turn('q', 'p', 2)})"
    crossing = F.struct(
        *[(F.round(F.expr(f"p.{v}1 + {along} * (p.{v}2 - p.{v}1)"), precision) + 0.0).alias(v) for v in ("x", "y")]
    )
    named = named.withColumn("c", F.when(crosses, crossing))
    splits = F.array(*[F.struct(F.col(s).alias("s"), F.col(at).alias("at")) for s in ("p", "q") for at in (f"{s}1", f"{s}2", "c")])
    found = named.select(*keys, F.explode(splits).alias("e")).where("e.at IS NOT NULL")
    return (
        found.select(*keys, "e.s.*", "e.at.x", "e.at.y")
        .where("NOT (x = x1 AND y = y1) AND NOT (x = x2 AND y = y2)")
        .distinct()
    )


def _fragments(segments: DataFrame, splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, segment (struct), x1, y1, x2, y2: every segment in its pieces, in its own direction."""
    whole = [*keys, *_ENDS]
    untouched = segments.join(splits.select(*whole).distinct(), whole, "left_anti")
    ends = splits.select(*whole).distinct().select(*whole, F.explode(F.expr("array(struct(x1 AS x, y1 AS y), struct(x2 AS x, y2 AS y))")).alias("e"))
    points = splits.unionByName(ends.select(*whole, "e.x", "e.y"))
    along = F.expr("(x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)")
    order = W.partitionBy(*whole).orderBy(along, "x", "y")
    pieces = (
        points.select(*keys, _struct(_ENDS).alias("segment"), *_ENDS, F.col("x"), F.col("y"))
        .withColumn("to", F.lead(F.struct("x", "y")).over(order))
        .where("to IS NOT NULL")
        .select(*keys, "segment", F.col("x").alias("_x"), F.col("y").alias("_y"), "to")
        .select(*keys, "segment", F.col("_x").alias("x1"), F.col("_y").alias("y1"), F.col("to.x").alias("x2"), F.col("to.y").alias("y2"))
    )
    return pieces.unionByName(untouched.select(*keys, _struct(_ENDS).alias("segment"), *_ENDS))


def _boundary(vertices: DataFrame, keys: Sequence[str], precision: int, keep: Keep) -> DataFrame:
    """Fragments with a part on exactly one side, directed so that it is the left one: keys, x1, y1, x2, y2."""
    tolerance = 0.75 * 10.0**-precision
    drawn = keep("union_edges", _canonical(_oriented(vertices, keys), F.lit(1)))
    segments = keep("union_segments", drawn.select(*keys, *_ENDS).distinct())
    splits = keep("union_splits", _split_points(_in_cells(segments, keys, tolerance, keep), keys, precision, tolerance))
    pieces = _canonical(_fragments(segments, splits, keys), F.lit(1)).withColumnRenamed("way", "turned")
    whose = drawn.select(*keys, "part", "way", _struct(_ENDS).alias("segment"))
    fragment = [*keys, *_ENDS]
    owned = keep(
        "union_fragments",
        pieces.join(whose, [*keys, "segment"])
        .groupBy(*fragment, "part").agg(F.sum(F.col("way") * F.col("turned")).alias("net"))
        .where("net <> 0"),
    )
    sides = owned.groupBy(*fragment).agg(F.max(F.col("net") > 0).alias("left"), F.max(F.col("net") < 0).alias("right")).where("left <> right")
    # a fragment within another part has that part on both sides
    middle = sides.select(*fragment, F.expr("(x1 + x2) / 2").alias("x"), F.expr("(y1 + y2) / 2").alias("y"))
    covered = geo.points_in_polygons(middle, vertices, [*keys, "part"], same=keys).select(*fragment, "part")
    inside = covered.join(owned.select(*fragment, "part"), [*fragment, "part"], "left_anti").select(*fragment).distinct()
    swap = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    return sides.join(inside, fragment, "left_anti").select(
        *keys, *[F.when(F.col("left"), F.col(c)).otherwise(F.col(swap[c])).alias(c) for c in _ENDS]
    )


def _linked(boundary: DataFrame, keys: Sequence[str], keep: Keep) -> DataFrame:
    """keys, x1, y1, x2, y2, ring (its least edge), steps (edges from this one on to that).

    Where several rings touch, an edge goes on to the first one clockwise from where it
    came, so that what hangs together by area alone stays a part.  Rings are followed by
    doubling: after k rounds an edge knows the least of the 2^k edges ahead.
    """
    arriving = boundary.select(*keys, _struct(_ENDS).alias("edge"), F.col("x2").alias("vx"), F.col("y2").alias("vy"))
    leaving = boundary.select(*keys, _struct(_ENDS).alias("on"), F.col("x1").alias("vx"), F.col("y1").alias("vy"))
    back = "atan2(edge.y1 - edge.y2, edge.x1 - edge.x2)"
    ahead = "atan2(on.y2 - on.y1, on.x2 - on.x1)"
    clockwise = F.expr(f"CASE WHEN {back} > {ahead} THEN {back} - {ahead} ELSE {back} - {ahead} + {2 * math.pi!r}D END")
    now = (
        arriving.join(leaving, [*keys, "vx", "vy"])
        .groupBy(*keys, "edge").agg(F.min_by("on", clockwise).alias("on"))
        .select(*keys, "edge", "on", F.col("edge").alias("ring"), F.lit(0).cast("long").alias("steps"))
    )
    now, span = keep("union_rings_1", now), 1
    while True:
        there = now.select(*keys, F.col("edge").alias("on"), F.col("on").alias("on2"), F.col("ring").alias("ring2"), F.col("steps").alias("steps2"))
        closer = F.col("ring2") < F.col("ring")
        span *= 2
        now = keep(
            f"union_rings_{span}",
            now.join(there, [*keys, "on"]).select(
                *keys, "edge", F.col("on2").alias("on"), F.least("ring", "ring2").alias("ring"),
                F.when(closer, F.col("steps2") + span // 2).otherwise(F.col("steps")).alias("steps"), closer.alias("moved"),
            ),
        )
        if now.where("moved").isEmpty():
            return now.select(*keys, "edge.*", "ring", "steps")
        now = now.drop("moved")


def _cornered(rings: DataFrame, ring: Sequence[str], tolerance: float) -> DataFrame:
    """Ring vertices (seq from 1, the first one not repeated) without those on the line of their neighbours, numbered anew."""
    size = rings.groupBy(*ring).agg(F.count("*").alias("n"))
    placed = rings.join(size, list(ring)).withColumn("seq", F.expr("CASE WHEN steps = 0 THEN 1 ELSE n - steps + 1 END"))
    told = F.explode(F.expr("array(struct(0 AS d, seq AS at), struct(1 AS d, IF(seq = n, 1, seq + 1) AS at), struct(-1 AS d, IF(seq = 1, n, seq - 1) AS at))"))
    around = (
        placed.select(*ring, told.alias("e"), F.struct("x1", "y1").alias("p"))
        .groupBy(*ring, F.col("e.at").alias("seq"))
        .agg(*[F.max(F.when(F.col("e.d") == d, F.col("p"))).alias(name) for d, name in ((1, "before"), (0, "own"), (-1, "after"))])
    )
    off = g.squared_distance_to_edge(*[F.col(c) for c in ("before.x1", "before.y1", "after.x1", "after.y1")], F.col("own.x1"), F.col("own.y1"))
    kept = around.where(off > tolerance * tolerance).select(
        *ring, "seq", F.col("own.x1").alias("x"), F.col("own.y1").alias("y"), F.expr(f"seq div {_STRETCH}").alias("stretch")
    )
    # numbers by stretches of a ring, so that a long one is in no task whole
    counts = kept.groupBy(*ring, "stretch").agg(F.count("*").alias("m"))
    earlier = W.partitionBy(*ring).orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*ring, "stretch", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy(*ring, "stretch").orderBy("seq"))
    numbered = kept.withColumn("rank", rank).join(starts, [*ring, "stretch"]).select(
        *ring, (F.col("start") + F.col("rank")).cast("int").alias("seq"), "x", "y"
    )
    return numbered


def _closed(numbered: DataFrame, ring: Sequence[str]) -> DataFrame:
    """The first vertex once more at the end of each ring."""
    size = numbered.groupBy(*ring).agg(F.max("seq").alias("n"))
    last = numbered.where("seq = 1").join(size, list(ring)).select(*ring, (F.col("n") + 1).cast("int").alias("seq"), "x", "y")
    return numbered.unionByName(last)


def union_outlines(
    vertices: DataFrame, keys: Sequence[str], precision: int = 9, keep: Keep = lambda _name, df: cut_lineage(df)
) -> DataFrame:
    """The union of all parts of each key as outlines: keys, part, ring, seq, x, y.

    Borders between parts vanish, what is covered twice counts once, and holes stay where
    no part covers them.  Shells run to the left around their part, holes to the right;
    vertices in the middle of a straight line are left out.  A part is named by where its
    shell starts, its lowest vertex.  Rings that touch themselves in a point stay one ring
    where the area hangs together beside it.

    Coordinates, crossings too, are taken at ``precision`` decimals; whatever lies nearer
    than three quarters of that unit counts as touching.  Parts are valid: rings are closed
    and do not cross themselves or each other, ring 1 is the shell.

    Cells with many edges are cut further, so none is a task's bulk; rings are followed in
    rounds, as many as the logarithm of the longest one.  The rounds are written by
    ``keep``, which has to store what it is given.
    """
    tolerance = 0.75 * 10.0**-precision
    keys = list(keys)
    rounded = vertices.select(
        *keys, "part", "ring", "seq", *[(F.round(v, precision) + 0.0).alias(v) for v in ("x", "y")]
    )
    boundary = keep("union_boundary", _boundary(rounded, keys, precision, keep))
    rings = _linked(boundary, keys, keep)
    corners = keep("union_corners", _cornered(rings, [*keys, "ring"], tolerance))
    name = F.concat_ws(" ", *[F.col(f"ring.{c}") for c in _ENDS])
    outline = _closed(corners.withColumn("name", name), [*keys, "ring", "name"])
    areas = (
        geo.edges(outline.select(*keys, F.col("name").alias("part"), F.lit(1).alias("ring"), "seq", "x", "y", "ring.x1", "ring.y1")
                  .select(*keys, "part", "ring", "seq", (F.col("x") - F.col("x1")).alias("x"), (F.col("y") - F.col("y1")).alias("y")), keys)
        .groupBy(*keys, F.col("part").alias("name")).agg(F.sum(F.expr("x1 * y2 - x2 * y1")).alias("area"))
    )
    told = keep("union_outlines", outline.join(areas.where("area <> 0"), [*keys, "name"]))
    shells = told.where("area > 0").select(*keys, F.col("name").alias("part"), F.lit(1).alias("ring"), "seq", "x", "y", "area")
    holes = told.where("area < 0 AND seq = 1").select(
        *keys, "name", "ring", F.expr("(ring.x1 + ring.x2) / 2").alias("x"), F.expr("(ring.y1 + ring.y2) / 2").alias("y")
    )
    sizes = shells.where("seq = 1").select(*keys, "part", "area")
    homes = (
        geo.points_in_polygons(holes, shells.drop("area"), [*keys, "part"], same=keys)
        .join(sizes, [*keys, "part"])
        .groupBy(*keys, "name", "ring").agg(F.min_by("part", "area").alias("part"))
    )
    number = F.row_number().over(W.partitionBy(*keys, "part").orderBy("ring")) + 1
    numbered = homes.select(*keys, "name", "part", number.alias("number"))
    inner = told.where("area < 0").join(numbered, [*keys, "name"]).select(
        *keys, "part", F.col("number").cast("int").alias("ring"), "seq", "x", "y"
    )
    return shells.drop("area").unionByName(inner)


def outline_measures(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, parts, rings, area, outline length of a layer whose parts do not overlap."""
    lines = geo.edges(vertices, keys)
    origin = vertices.groupBy(*keys).agg(F.min("x").alias("ox"), F.min("y").alias("oy"))
    rings = (
        lines.join(origin, list(keys))
        .groupBy(*keys, "part", "ring", F.expr(f"seq div {_STRETCH}").alias("stretch"))
        .agg(F.sum(F.expr("(x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy)")).alias("a"), F.sum(F.expr("hypot(x2 - x1, y2 - y1)")).alias("l"))
        .groupBy(*keys, "part", "ring").agg(F.abs(F.sum("a") / 2).alias("a"), F.sum("l").alias("l"))
    )
    return rings.groupBy(*keys).agg(
        F.count(F.when(F.col("ring") == 1, 1)).alias("n_parts"), F.count("*").alias("n_rings"),
        F.sum(F.when(F.col("ring") == 1, F.col("a")).otherwise(-F.col("a"))).alias("area"), F.sum("l").alias("outline"),
    )
