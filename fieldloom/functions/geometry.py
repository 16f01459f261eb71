"""Planar geometry as column expressions.

An edge is a struct x1, y1, x2, y2.  Tests use the cross product of the edge with
the point, so no division can fail in ANSI mode and the "on the edge" and "left of
the edge" answers agree with each other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# {x} and {y} stand for the point, e for the edge
_SIDE = "((e.x2 - e.x1) * ({y} - e.y1) - ({x} - e.x1) * (e.y2 - e.y1))"
_ON_EDGE = (
    "{y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
    f"AND {_SIDE} = 0"
)
# the ray from the point towards +x, half-open in y
_CROSSES = f"((e.y1 <= {{y}} AND e.y2 > {{y}} AND {_SIDE} > 0) OR (e.y2 <= {{y}} AND e.y1 > {{y}} AND {_SIDE} < 0))"


def surrounds(edges: str, x: str, y: str, crossed: str = "0") -> Column:
    """An odd number of ray crossings: membership of a point that lies on no edge.

    ``edges`` names an array of edges and may leave out ones that the point's ray
    does not meet, and ones that it surely crosses if ``crossed`` counts them; ``x``,
    ``y`` and ``crossed`` are SQL expressions.  Holes need no care: their edges flip
    the parity back.
    """
    return F.expr(f"(size(filter({edges}, e -> {_CROSSES})) + {crossed}) % 2 = 1".format(x=f"({x})", y=f"({y})"))


def covers(edges: str, x: str, y: str, crossed: str = "0") -> Column:
    """Closed membership: surrounded, or on an edge; ``edges`` may not leave out one under the point."""
    on_some = F.expr(f"exists({edges}, e -> {_ON_EDGE})".format(x=f"({x})", y=f"({y})"))
    return surrounds(edges, x, y, crossed) | on_some


def _off_edge(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> tuple[Column, Column]:
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.coalesce(F.try_divide((x - x1) * dx + (y - y1) * dy, length2), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return x - (x1 + t * dx), y - (y1 + t * dy)


def distance_to_edge(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """Distance from the point to the closed edge."""
    return F.hypot(*_off_edge(x1, y1, x2, y2, x, y))


def squared_distance_to_edge(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """Its square, by plain products, whose bits do not hang on a library's root."""
    off_x, off_y = _off_edge(x1, y1, x2, y2, x, y)
    return off_x * off_x + off_y * off_y
