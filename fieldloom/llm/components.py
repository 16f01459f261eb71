"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import stage


def _starred(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Each edge (node, other) with the smallest id around its node."""
    least = edges.groupBy(node).agg(F.least(F.min(other), F.col(node)).alias("least"))
    return edges.join(least, node)


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, component): the smallest id reachable, for every node that has a link to another one.

    Rounds of two steps: every node hands the smallest id around it first to its larger
    neighbours, then to its smaller ones, until the links are stars around the smallest
    ids.  The links never grow in number, the rounds with the logarithm of the nodes; a
    node with very many links is combined before the shuffle and split by the join.
    ``rows``: how many links come at most, if that is known.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links", rows
    )
    mark, rows = None, now.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both, "u", "v").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _starred(large, "u", "v")
        now = stage(
            small.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(small.select("u", F.col("least").alias("v")))
            .filter("u <> v")
            .distinct(),
            "links",
            rows,
        )
        # equal sums of 64-bit hashes over equal counts: the links did not change
        last, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == last or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
