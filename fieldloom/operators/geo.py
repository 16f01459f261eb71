"""Polygon layers, point-in-polygon join, centroids, nearest polygon.

A polygon layer is a long table of ring vertices: the layer's key columns plus
``part, ring, seq, x, y``.  ``ring`` 1 of a part is its shell and further rings
are holes; rings are closed (last vertex = first) and ``seq`` counts up by one.
Keys are not NULL.

The joins work on cells whose sides are powers of four, chosen per part and axis so
that a part is about 4 to 16 cells across, more if it has many vertices.  Small
sites and wide ranges can then share one equi join on (levels, cell), with no limit
on the cells of a part and no cell size to guess.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldloom.functions import geometry as g

# a part of any extent has a level: beyond these it merely has more cells, or fewer, across
_FINEST, _COARSEST = -20, 20
# cells of a row that one task gathers edges for
_BLOCK = 16


def edges(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ring edge: keys, part, ring, seq, x1, y1, x2, y2.

    A vertex is the start of one edge and the end of the one before; both meet in an
    aggregate by the number of the edge.  So the layer is read once, and a huge ring is
    spread over all tasks where a window would sort it in one.
    """
    of_edge = F.explode(
        F.array(
            F.struct(F.col("seq").alias("seq"), F.lit(True).alias("starts")),
            F.struct((F.col("seq") - 1).alias("seq"), F.lit(False).alias("starts")),
        )
    )
    ends = vertices.select(*keys, "part", "ring", of_edge.alias("e"), "x", "y")
    return (
        ends.groupBy(*keys, "part", "ring", F.col("e.seq").alias("seq"))
        .agg(
            *[
                F.max(F.when(F.col("e.starts") if n == 1 else ~F.col("e.starts"), F.col(v))).alias(f"{v}{n}")
                for n in (1, 2)
                for v in ("x", "y")
            ]
        )
        .where("x1 IS NOT NULL AND x2 IS NOT NULL")
    )


# sides of a cell: powers of four, so exact
_SIDE = "pow(4.0D, level)"
_RISE = "pow(4.0D, rise)"


def _cell(value: str, side: str = _SIDE) -> Column:
    return F.expr(f"floor(({value}) / {side})")


def _cells(low: str, high: str, side: str = _SIDE) -> Column:
    """The numbers of all cells between two values, one row each."""
    return F.explode(F.sequence(_cell(low, side), _cell(high, side)))


def _part_levels(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The grid levels of every part, ``level`` along x and ``rise`` along y, and its first cell.

    Each comes from the extent along its axis and the number of vertices n.  A part is
    at most 16, or a quarter of root n, cells across.  So its cells do not outnumber its
    vertices (or 256), and a flat outline has as many rows as a tall one.
    """
    across = "greatest(16D, sqrt(count(x)) / 4)"

    def level(axis: str) -> Column:
        extent = f"greatest(max({axis}) - min({axis}), 1e-30D)"
        return F.expr(f"CAST(greatest({_FINEST}, least({_COARSEST}, ceil(log2({extent} / {across}) / 2))) AS INT)")

    levels = vertices.groupBy(*keys, "part").agg(level("x").alias("level"), level("y").alias("rise"), F.min("x").alias("left"))
    return levels.select(*keys, "part", "level", "rise", _cell("left").alias("left"))


CELL = ["level", "rise", "cx", "cy"]


def polygon_cells(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells that a polygon part reaches: keys, part, level, rise, cx, cy, whole, crossed, segs.

    ``segs`` holds the edges that enter the cell and, of those right of it, the ones
    with an end inside its row of cells: whether a point's ray crosses these hangs on
    the point.  Edges right of the cell that pass through the whole row are crossed in
    any case and only counted, in ``crossed``.  A cell that no edge enters is either
    dropped or marked ``whole``, and then carries none.

    Edges are gathered per block of cells of a row, dealt over the tasks by row and
    block, not by outline.  Every edge is told to all blocks of its row from the part's
    first one on, so a block knows what lies right of it, and a block that nothing was
    told to lies outside: one aggregate makes the layer.
    """
    part = [*keys, "part", "level", "rise"]
    row = [*part, "cy"]
    block = f"floor(%s / {_BLOCK})"
    entered = (
        edges(vertices, keys)
        .join(_part_levels(vertices, keys), [*keys, "part"])
        .withColumn("cy", _cells("least(y1, y2)", "greatest(y1, y2)", _RISE))
        .withColumn("first", _cell("least(x1, x2)"))
        .withColumn("last", _cell("greatest(x1, x2)"))
        .withColumn("through", F.expr(f"least(y1, y2) <= cy * {_RISE} AND greatest(y1, y2) >= (cy + 1) * {_RISE}"))
        # the half-open ray misses level edges and edges that end at the foot of the row
        .withColumn("partly", F.expr(f"NOT through AND y1 <> y2 AND greatest(y1, y2) > cy * {_RISE}"))
    )
    told = (
        entered.withColumn("own", F.expr(block % "first"))
        .withColumn("from", F.expr(f"CASE WHEN through OR partly THEN least({block % '`left`'}, own) ELSE own END"))
        .withColumn("block", F.explode(F.expr(f"sequence(`from`, {block % 'last'})")))
        .withColumn("e", F.when(F.expr("partly OR block >= own"), F.struct("x1", "y1", "x2", "y2", "through", "partly")))
        .select(*row, "block", "e", F.expr("IF(e IS NULL, 1, 0)").alias("passes"), "left", "last")
        .repartition(*row, "block")
    )
    rows = told.groupBy(*row, "block").agg(
        F.collect_list("e").alias("row_segs"),
        F.sum("passes").alias("beyond"),
        F.expr(f"greatest(min(`left`), block * {_BLOCK})").alias("low"),
        F.expr(f"least(max(last), block * {_BLOCK} + {_BLOCK - 1})").alias("high"),
    )
    enters = f"(greatest(e.x1, e.x2) >= cx * {_SIDE} AND least(e.x1, e.x2) <= (cx + 1) * {_SIDE})"
    right = f"least(e.x1, e.x2) > (cx + 1) * {_SIDE}"
    return (
        rows.withColumn("cx", F.explode(F.expr("sequence(low, high)")))
        .withColumn("whole", F.expr(f"NOT exists(row_segs, e -> {enters})"))
        .where(~F.col("whole") | g.surrounds("row_segs", f"(cx + 0.5D) * {_SIDE}", f"(cy + 0.5D) * {_RISE}", "beyond"))
        .select(
            *part, "cx", "cy", "whole",
            F.expr(f"beyond + size(filter(row_segs, e -> e.through AND {right}))").alias("crossed"),
            F.expr(
                f"transform(filter(row_segs, e -> NOT whole AND ({enters} OR (e.partly AND {right}))), "
                "e -> struct(e.x1 AS x1, e.y1 AS y1, e.x2 AS x2, e.y2 AS y2))"
            ).alias("segs"),
        )
    )


def points_in_cells(
    points: DataFrame, cells: DataFrame, levels: Column, keys: Sequence[str], same: Sequence[str] = ()
) -> DataFrame:
    """Points (with x, y) joined to the polygon parts that cover them, over the cells of the layer.

    ``cells`` come from :func:`polygon_cells` or from where they were stored.  A point
    lies in one cell per pair of ``levels`` (an array of structs level, rise), so it goes
    into the join once for each pair.  Columns in ``same``, of the points and of the
    layer, must agree as well.
    """
    placed = (
        points.withColumn("_used", F.explode(levels))
        .withColumn("level", F.col("_used.level"))
        .withColumn("rise", F.col("_used.rise"))
        .withColumn("cx", _cell("x"))
        .withColumn("cy", _cell("y", _RISE))
    )
    return (
        placed.join(cells, [*same, *CELL])
        .where(F.col("whole") | g.covers("segs", "x", "y", "crossed"))
        .select(*points.columns, *[k for k in keys if k not in same])
    )


def used_levels(cells: DataFrame) -> Column:
    """The pairs of levels in use, by a scalar subquery over the parts, or over stored cells."""
    return cells.agg(F.collect_set(F.struct("level", "rise"))).scalar()


@dataclass(frozen=True)
class CellLayer:
    """A polygon layer made ready for the joins and stored: its outlines, cells, levels in use and centroids."""

    vertices: DataFrame
    cells: DataFrame
    levels: Column
    centroids: DataFrame


Layer = DataFrame | CellLayer


def outlines(layer: Layer) -> DataFrame:
    return layer.vertices if isinstance(layer, CellLayer) else layer


class DifferentSrid(ValueError):
    """Coordinates of different reference systems were to meet."""


def with_srid(df: DataFrame, srid: int) -> DataFrame:
    """``df`` with the reference system told by its columns x and y, as metadata that selections and files keep."""
    told = {"srid": int(srid)}
    return df.select(*[F.col(c).alias(c, metadata=told) if c in ("x", "y") else F.col(f"`{c}`") for c in df.columns])


def srid_of(df: DataFrame) -> int | None:
    """The reference system that x and y tell; None where nothing is said."""
    found = {f.metadata["srid"] for f in df.schema.fields if f.name in ("x", "y") and "srid" in f.metadata}
    if len(found) > 1:
        raise DifferentSrid(f"x and y are of different reference systems: {sorted(found)}")
    return found.pop() if found else None


def check_srid(points: DataFrame, layer: Layer) -> None:
    """Refuse points and outlines of different reference systems; what says nothing meets anything."""
    told = {srid_of(points), srid_of(outlines(layer))} - {None}
    if len(told) > 1:
        raise DifferentSrid(f"points and outlines are of different reference systems: {sorted(told)}")


def points_in_polygons(points: DataFrame, vertices: Layer, keys: Sequence[str], same: Sequence[str] = ()) -> DataFrame:
    """Points (with x, y) joined to every polygon part that covers them; boundaries count.

    Adds the layer's ``keys`` to the point columns.  A polygon with overlapping
    parts yields one row per part; callers that want a union drop duplicates.  A stored
    layer is read as it lies, outlines are made into cells first.
    """
    check_srid(points, vertices)
    if isinstance(vertices, CellLayer):
        return points_in_cells(points, vertices.cells, vertices.levels, keys, same)
    layer = [k for k in keys if k != "part"]
    return points_in_cells(points, polygon_cells(vertices, layer), used_levels(_part_levels(vertices, layer)), keys, same)


def centroids(vertices: Layer, keys: Sequence[str]) -> DataFrame:
    """Area centroid per polygon: keys, x, y.

    Sums run relative to a corner of the polygon's box, so small sites far from
    the origin keep their digits.  Shells count positive and holes negative
    whatever way they wind.  A polygon without area falls back to the centroid of
    its outline, and one without length to its only point.
    """
    if isinstance(vertices, CellLayer):
        return vertices.centroids
    origin = vertices.groupBy(*keys).agg(F.min("x").alias("ox"), F.min("y").alias("oy"))
    rel = (
        edges(vertices, keys)
        .join(origin, list(keys))
        .select(
            *keys, "part", "ring", "ox", "oy", F.expr("seq div 1000").alias("stretch"),
            *[(F.col(c) - F.col("o" + c[0])).alias(c) for c in ("x1", "y1", "x2", "y2")],
        )
    )
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    sums = ["a", "ax", "ay", "l", "lx", "ly"]
    # edges are summed by stretches of a ring before the ring, so no task takes a huge outline whole
    stretches = rel.repartition(*keys, "part", "ring", "stretch").groupBy(*keys, "part", "ring", "ox", "oy", "stretch").agg(
        F.sum(cross).alias("a"),
        F.sum((F.col("x1") + F.col("x2")) * cross).alias("ax"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("ay"),
        F.sum(length).alias("l"),
        F.sum((F.col("x1") + F.col("x2")) * length).alias("lx"),
        F.sum((F.col("y1") + F.col("y2")) * length).alias("ly"),
    )
    rings = stretches.groupBy(*keys, "part", "ring", "ox", "oy").agg(*[F.sum(c).alias(c) for c in sums])
    # signum(a) makes the ring's area positive; a hole then takes it away again
    sign = F.signum("a") * F.when(F.col("ring") == 1, 1).otherwise(-1)

    def centre(axis: str) -> Column:
        by_area = F.try_divide(F.sum(sign * F.col("a" + axis)), 3 * F.sum(sign * F.col("a")))
        by_length = F.try_divide(F.sum("l" + axis), 2 * F.sum("l"))
        return (F.col("o" + axis) + F.coalesce(by_area, by_length, F.lit(0.0))).alias(axis)

    return rings.groupBy(*keys, "ox", "oy").agg(centre("x"), centre("y")).select(*keys, "x", "y")


def passed_cells(lines: DataFrame, pad: float = 0.0) -> DataFrame:
    """Each edge in the cells of its ``level`` that it passes: in each row at the cells under its piece there
    and one more to either side, so that rounding leaves none out.

    With a ``pad``, no larger than a cell, in all cells that hold a point so near to the edge.
    """
    foot, head = f"cy * {_SIDE} - {pad!r}D", f"(cy + 1) * {_SIDE} + {pad!r}D"
    return (
        lines.withColumn("cy", _cells(f"least(y1, y2) - {pad!r}D", f"greatest(y1, y2) + {pad!r}D"))
        .withColumn("from", F.expr(f"least(1D, greatest(0D, coalesce(try_divide({foot} - y1, y2 - y1), 0D)))"))
        .withColumn("to", F.expr(f"least(1D, greatest(0D, coalesce(try_divide({head} - y1, y2 - y1), 1D)))"))
        .withColumn("xa", F.expr("x1 + `from` * (x2 - x1)"))
        .withColumn("xb", F.expr("x1 + `to` * (x2 - x1)"))
        .withColumn("cx", _cells(f"least(xa, xb) - {_SIDE}", f"greatest(xa, xb) + {_SIDE}"))
        .drop("from", "to", "xa", "xb")
    )


def _entered(lines: DataFrame, level: int) -> DataFrame:
    return passed_cells(lines.withColumn("level", F.lit(level))).drop("level")


def _reach(side: float, cx: str, cy: str) -> tuple[str, str]:
    """SQL for the least distance of (x, y) to a cell, and for one within which it has some edge."""
    near = [f"greatest({c} * {side!r}D - {v}, {v} - ({c} + 1) * {side!r}D, 0D)" for c, v in ((cx, "x"), (cy, "y"))]
    # the edge may lie one cell beside
    far = [f"greatest({v} - ({c} - 1) * {side!r}D, ({c} + 2) * {side!r}D - {v})" for c, v in ((cx, "x"), (cy, "y"))]
    return f"hypot({near[0]}, {near[1]})", f"hypot({far[0]}, {far[1]})"


def nearest_polygon(points: DataFrame, vertices: Layer, point_key: str, polygon_key: str) -> DataFrame:
    """The polygon nearest to each point outside all of them: point_key, polygon_key, distance.

    Ties go to the lowest polygon key.  Exact at any distance, by going down a pyramid of
    cells that edges pass.  Its levels follow from the extent of the layer and the number
    of its edges; a long edge is entered in each cell that it passes.  The top level, at
    most some 20 x 20 cells, is looked through in one expression; each level below is one
    equi join of the cells kept with their children.  A cell is kept if its least distance
    is not above the best distance that another one warrants, so a point keeps few cells
    on each level, wherever it lies.
    """
    check_srid(points, vertices)
    lines = edges(outlines(vertices), [polygon_key]).select(polygon_key, "x1", "y1", "x2", "y2")
    low, high = (F.least, F.min), (F.greatest, F.max)
    spans = [high[1](high[0](f"{v}1", f"{v}2")) - low[1](low[0](f"{v}1", f"{v}2")) for v in "xy"]
    shape = lines.agg(F.greatest(*spans).alias("extent"), F.count("*").alias("n")).first()
    extent = max(shape["extent"] or 0.0, 1e-12)
    top = math.ceil(math.log(extent / 16, 4))
    finest = min(top, math.ceil(math.log(extent / math.sqrt(max(shape["n"], 1)), 4)))

    celled = _entered(lines, finest)
    occupied = {finest: celled.select("cx", "cy").distinct()}
    for level in range(finest + 1, top + 1):
        below = occupied[level - 1]
        occupied[level] = below.select(F.floor(F.col("cx") / 4).alias("cx"), F.floor(F.col("cy") / 4).alias("cy")).distinct()
    # bounded by the choice of the top level
    start = [(r["cx"], r["cy"]) for r in occupied[top].collect()]
    cells = F.array(*[F.struct(F.lit(cx).cast("long").alias("cx"), F.lit(cy).cast("long").alias("cy")) for cx, cy in start])
    cells = cells.cast("array<struct<cx:bigint,cy:bigint>>")

    least, enough = _reach(4.0**top, "c.cx", "c.cy")
    kept = (
        points.select(point_key, "x", "y").withColumn("cells", cells)
        .withColumn("best", F.expr(f"array_min(transform(cells, c -> {enough})) * (1 + 1e-9D)"))
        .select(point_key, "x", "y", F.explode(F.expr(f"filter(cells, c -> {least} <= best)")).alias("c"))
        .select(point_key, "x", "y", "c.cx", "c.cy")
    )
    for level in range(top - 1, finest - 1, -1):
        children = occupied[level].select(
            F.floor(F.col("cx") / 4).alias("cx"), F.floor(F.col("cy") / 4).alias("cy"), F.struct("cx", "cy").alias("child")
        )
        least, enough = _reach(4.0**level, "cx", "cy")
        kept = (
            kept.join(children, ["cx", "cy"]).select(point_key, "x", "y", "child.cx", "child.cy")
            .withColumn("best", F.min(F.expr(f"{enough} * (1 + 1e-9D)")).over(W.partitionBy(point_key)))
            .where(F.expr(f"{least} <= best"))
            .drop("best")
        )
    distance = g.distance_to_edge(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("x"), F.col("y"))
    return (
        kept.join(celled, ["cx", "cy"])
        .groupBy(point_key)
        .agg(F.min(F.struct(distance.alias("distance"), F.col(polygon_key))).alias("best"))
        .select(point_key, F.col(f"best.{polygon_key}").alias(polygon_key), F.col("best.distance").alias("distance"))
    )


def polygons_within(points: DataFrame, vertices: Layer, point_key: str, polygon_key: str, distance: float) -> DataFrame:
    """Polygons at most ``distance`` from each point: point_key, polygon_key, distance (0 inside and on the border).

    Edges are entered in all cells that hold a point so near to them, points in their own
    one: an equi join, whatever the distance.  Cells are no smaller than the distance, so an
    edge that is short beside it enters few of them; they grow with the spacing of the
    edges, not with the extent.  Polygons around a point come from the join of points and
    polygons.  A negative distance is met by nothing.
    """
    check_srid(points, vertices)
    placed = points.select(point_key, "x", "y")
    lines = edges(outlines(vertices), [polygon_key]).select(polygon_key, "x1", "y1", "x2", "y2")
    spans = [F.max(F.greatest(f"{v}1", f"{v}2")) - F.min(F.least(f"{v}1", f"{v}2")) for v in "xy"]
    shape = lines.agg(F.greatest(*spans).alias("extent"), F.count("*").alias("n")).first()
    spacing = (shape["extent"] or 0.0) / math.sqrt(max(shape["n"], 1)) / 4
    level = math.ceil(math.log(max(distance, spacing, 1e-12), 4))
    celled = passed_cells(lines.withColumn("level", F.lit(level)), max(distance, 0.0))
    own = placed.withColumn("level", F.lit(level)).withColumn("cx", _cell("x")).withColumn("cy", _cell("y"))
    away = g.distance_to_edge(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("x"), F.col("y"))
    near = own.join(celled, ["level", "cx", "cy"]).select(point_key, polygon_key, away.alias("distance")).where(F.col("distance") <= distance)
    around = points_in_polygons(placed, vertices, [polygon_key]).select(point_key, polygon_key, F.lit(0.0).alias("distance"))
    both = near.unionByName(around.where(F.lit(distance >= 0)))
    return both.groupBy(point_key, polygon_key).agg(F.min("distance").alias("distance"))
