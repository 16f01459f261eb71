"""Focal taxa, their ranges, and the sites that lie in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators import geo, overlay

RANGE_KEYS = ["sp_id", "taxon_id", "range_id"]


def flag_focal_taxa(taxonomy: DataFrame, focal_list: DataFrame) -> DataFrame:
    """Taxonomy with ``focal`` taken afresh from the list; unlisted taxa get NULL.

    A taxon listed twice keeps one row, with the largest flag; ``read_csv`` with
    ``unique`` refuses such a list on load.
    """
    listed = focal_list.groupBy("taxon_id").agg(F.max(F.col("focal").cast("short")).alias("focal"))
    return taxonomy.drop("focal").join(listed, "taxon_id", "left")


def dissolve_ranges(range_vertex: DataFrame, taxon_range_link: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Ranges of focal taxa as one multi-part layer keyed by species, taxon and range class.

    A taxon may be linked to several source ranges (hybrid zones); they become
    parts of its range.  Membership needs no more, as a point is in a union exactly when
    it is in a part; ``merged_ranges`` makes the parts one.
    """
    focal = taxonomy.where(F.col("focal").isNotNull()).select("taxon_id", "sp_id")
    links = taxon_range_link.join(focal, "taxon_id").select("sp_id", "taxon_id", "range_taxon_id").distinct()
    return range_vertex.join(links, "range_taxon_id").select(
        *RANGE_KEYS, F.concat_ws("/", "range_taxon_id", "part").alias("part"), "ring", "seq", "x", "y"
    )


def merged_ranges(ranges: DataFrame, precision: int = 9, **options) -> DataFrame:
    """Ranges with their overlapping parts made one, as outlines; see :func:`overlay.union_outlines`."""
    return overlay.union_outlines(ranges, RANGE_KEYS, precision, **options)


def site_centroids(sites: DataFrame, site_vertex: geo.Layer) -> DataFrame:
    """Centroid of every site: site_id, site_type, site_permutation, x, y."""
    return sites.select("site_id", "site_type", "site_permutation").join(
        geo.centroids(site_vertex, ["site_id"]), "site_id"
    )


def sites_in_ranges(centroids: DataFrame, ranges: geo.Layer) -> DataFrame:
    """Sites whose centroid lies in a taxon's range, once per range class."""
    return geo.points_in_polygons(centroids.select("site_id", "site_type", "x", "y"), ranges, RANGE_KEYS).select(
        "site_id", "site_type", *RANGE_KEYS
    ).distinct()


def taxon_coverage(facts: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows per taxon (or species): which ones have come through a stage."""
    return facts.groupBy(*([key] if isinstance(key, str) else key)).agg(F.count("*").alias("n"))


def distinct_taxa(facts: DataFrame) -> DataFrame:
    """The taxa of a stage, sorted."""
    return facts.select("taxon_id").distinct().orderBy("taxon_id")


def sites_with_geometry(located: DataFrame, site_vertex: geo.Layer) -> DataFrame:
    """Range membership rows with the outline of their site, for a look on a map."""
    return located.join(geo.outlines(site_vertex), "site_id")
