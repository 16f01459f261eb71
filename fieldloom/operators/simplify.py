"""Line simplification of polygon rings (Douglas-Peucker).

A ring keeps its first vertex and, between two kept vertices, the one farthest
from the segment joining them if it is farther than the tolerance.  What happens
between two kept vertices does not depend on the rest of the ring, which is how a
long ring is spread: rounds of plain aggregation split its segments until each is
short enough for one task, and the segments are then finished independently.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.constants import SIMPLIFY_TOLERANCE
from fieldloom.functions.geometry import squared_distance_to_edge
from fieldloom.session import cut_lineage

LONGEST_SEGMENT = 200_000
SMALLEST_RING = 4


def _kept(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of an open or closed line stay."""
    keep = np.zeros(len(x), dtype=bool)
    keep[[0, -1]] = True
    todo = [(0, len(x) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        px, py = x[a + 1 : b], y[a + 1 : b]
        dx, dy = x[b] - x[a], y[b] - y[a]
        length2 = dx * dx + dy * dy
        t = np.clip(((px - x[a]) * dx + (py - y[a]) * dy) / length2, 0.0, 1.0) if length2 else np.zeros(len(px))
        off_x, off_y = px - (x[a] + t * dx), py - (y[a] + t * dy)
        # squares, in the order that _split_long_segments takes them: both judge every vertex alike
        distance2 = off_x * off_x + off_y * off_y
        far = int(distance2.argmax())
        if distance2[far] > tolerance * tolerance:
            middle = a + 1 + far
            keep[middle] = True
            todo += [(a, middle), (middle, b)]
    return keep


def _split_long_segments(points: DataFrame, ring: list[str], tolerance: float, longest: int) -> DataFrame:
    """Split segments of more than ``longest`` vertices at their farthest vertex, in rounds.

    ``points`` carry ``a`` and ``b``, the vertex numbers their segment runs between.
    Inner vertices of a segment that needs no split are dropped; the vertex a
    segment is split at then starts one and ends another.
    """
    segment = [*ring, "a", "b"]
    while True:
        sizes = points.groupBy(*segment).agg(F.count("*").alias("n"))
        long = sizes.where(F.col("n") > longest).select(*segment)
        if long.isEmpty():
            return points
        ends = points.join(long, segment).where((F.col("seq") == F.col("a")) | (F.col("seq") == F.col("b")))
        corners = ends.groupBy(*segment).agg(
            *[F.max(F.when(F.col("seq") == F.col(e), F.col(v))).alias(f"{v}{e}") for e in "ab" for v in "xy"]
        )
        inner = points.join(corners, segment).where((F.col("seq") > F.col("a")) & (F.col("seq") < F.col("b")))
        distance2 = squared_distance_to_edge(F.col("xa"), F.col("ya"), F.col("xb"), F.col("yb"), F.col("x"), F.col("y"))
        # farthest first, then the lowest vertex number
        farthest = inner.groupBy(*segment).agg(
            F.max(F.struct(distance2.alias("d"), (-F.col("seq")).alias("s"), "x", "y")).alias("far")
        )
        cut = farthest.select(
            *segment, F.when(F.col("far.d") > tolerance * tolerance, -F.col("far.s")).alias("m"), F.lit(True).alias("long")
        )
        seen = points.join(cut, segment, "left")
        flat = F.col("long").isNotNull() & F.col("m").isNull()
        kept = seen.where(~flat | (F.col("seq") == F.col("a")) | (F.col("seq") == F.col("b")))
        halves = F.when(F.col("m").isNull(), F.array(F.struct("a", "b"))).otherwise(
            F.filter(
                F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("m").alias("a"), "b")),
                lambda s: (F.col("seq") >= s["a"]) & (F.col("seq") <= s["b"]),
            )
        )
        points = cut_lineage(
            kept.withColumn("half", F.explode(halves)).select(
                *ring, "seq", "x", "y", F.col("half.a").alias("a"), F.col("half.b").alias("b")
            )
        )


def simplify_rings(
    vertices: DataFrame,
    keys: Sequence[str],
    tolerance: float = SIMPLIFY_TOLERANCE,
    longest_segment: int = LONGEST_SEGMENT,
) -> DataFrame:
    """The polygon layer with fewer vertices, numbered anew; ``tolerance`` 0 or less leaves it as it is.

    A ring left with fewer than four vertices has collapsed and is dropped.
    """
    if tolerance <= 0:
        return vertices
    ring = [*keys, "part", "ring", "last"]
    span = vertices.groupBy(*keys, "part", "ring").agg(F.min("seq").alias("a"), F.max("seq").alias("last"))
    points = vertices.select(*keys, "part", "ring", "seq", "x", "y").join(span, [*keys, "part", "ring"])
    points = _split_long_segments(points.withColumn("b", F.col("last")), ring, tolerance, longest_segment)
    kinds = points.select(*ring, "a", "x", "y").schema.add("position", T.IntegerType())

    def finish(segment: pd.DataFrame) -> pd.DataFrame:
        ordered = segment.sort_values("seq")
        kept = ordered[_kept(ordered["x"].to_numpy(), ordered["y"].to_numpy(), tolerance)]
        if kept["b"].iloc[0] != kept["last"].iloc[0]:
            kept = kept.iloc[:-1]  # the next segment starts with it
        return kept.assign(position=np.arange(len(kept), dtype=np.int32))[kinds.names]

    # dealt by segment: the segments of a huge ring are finished in many tasks
    left = points.repartition(*ring, "a", "b").groupBy(*ring, "a", "b").applyInPandas(finish, kinds)
    # vertex numbers run on from segment to segment; a ring has few of these
    whole = Window.partitionBy(*ring)
    before = F.sum("n").over(whole.orderBy("a").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        left.groupBy(*ring, "a")
        .agg(F.count("*").alias("n"))
        .select(*ring, "a", F.coalesce(before, F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("size"))
        .where(F.col("size") >= SMALLEST_RING)
    )
    number = (F.col("offset") + F.col("position") + 1).cast("int")
    return left.join(offsets, [*ring, "a"]).withColumn("seq", number).select(*vertices.columns)
