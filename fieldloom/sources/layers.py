"""Polygon layers stored ready for the joins: cells by bucket, centroids beside them.

A layer is worked out once, when its outlines are loaded.  Every later join of points
reads the cells where they lie: only the points are shuffled, and no outline is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import geo
from fieldloom.sources.tables import open_bucketed, save_bucketed

BUCKETS = 64


def store_layer(
    vertices: DataFrame, keys: Sequence[str], name: str, folder: str, buckets: int = BUCKETS
) -> geo.CellLayer:
    """Write the cells and centroids of a layer to ``folder``; the cells are table ``name``_cells of the catalog.

    ``buckets`` fixes the layout: choose it so that a bucket fits a task, as with shuffle partitions.
    """
    save_bucketed(geo.polygon_cells(vertices, keys), f"{name}_cells", geo.CELL, buckets, f"{folder}/{name}_cells")
    geo.centroids(vertices, keys).write.mode("overwrite").parquet(f"{folder}/{name}_centroids")
    return open_layer(vertices, keys, name, folder, buckets)


def open_layer(vertices: DataFrame, keys: Sequence[str], name: str, folder: str, buckets: int = BUCKETS) -> geo.CellLayer:
    """A stored layer, in the session that wrote it or a later one.

    The pairs of levels in use, at most 41 x 41, are read when the layer is opened.
    """
    spark: SparkSession = vertices.sparkSession
    cells = open_bucketed(spark, f"{name}_cells", geo.CELL, buckets, f"{folder}/{name}_cells")
    pairs = sorted((r["level"], r["rise"]) for r in cells.select("level", "rise").distinct().collect())
    levels = F.array(*[F.struct(F.lit(a).alias("level"), F.lit(b).alias("rise")) for a, b in pairs])
    return geo.CellLayer(
        vertices, cells, levels.cast("array<struct<level:int,rise:int>>"), spark.read.parquet(f"{folder}/{name}_centroids")
    )
