"""Regions of sites, and the wide one-column-per-year table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.constants import MAIN_RANGE, WIDE_YEARS
from fieldloom.functions.rates import mean_where
from fieldloom.operators import geo

_REGION_COLUMNS = ["region_name", "region_centroid_longitude", "region_centroid_latitude"]


def region_centroids(regions: DataFrame, region_vertex: geo.Layer) -> DataFrame:
    """Regions (region_id, region_name, region_code) with their centroid x, y."""
    return regions.select("region_id", "region_name", "region_code").join(
        geo.centroids(region_vertex, ["region_id"]), "region_id"
    )


def site_region(
    site_centroids: DataFrame, regions: DataFrame, region_vertex: geo.Layer, pick: str | None = None
) -> DataFrame:
    """The region that covers each site's centroid: site_id, region_id, region_name, x, y of the region.

    A centroid on a shared border has several; ``pick="min"`` keeps the lowest id.
    """
    inside = geo.points_in_polygons(site_centroids.select("site_id", "x", "y"), region_vertex, ["region_id"])
    pairs = inside.select("site_id", "region_id").distinct()
    if pick == "min":
        pairs = pairs.groupBy("site_id").agg(F.min("region_id").alias("region_id"))
    return pairs.join(region_centroids(regions, region_vertex), "region_id").select(
        "site_id", "region_id", "region_name", "x", "y"
    )


def nearest_region(
    site_centroids: DataFrame, site_region: DataFrame, regions: DataFrame, region_vertex: geo.Layer
) -> DataFrame:
    """The nearest region of every site that lies in none: site_id, region_code, distance."""
    missing = site_centroids.select("site_id", "x", "y").join(site_region, "site_id", "left_anti")
    found = geo.nearest_polygon(missing, region_vertex, "site_id", "region_id")
    return found.join(regions.select("region_id", "region_code"), "region_id").select(
        "site_id", "region_code", "distance"
    )


def fill_nearest_region(
    wide: DataFrame, nearest: DataFrame, regions: DataFrame, region_vertex: geo.Layer
) -> DataFrame:
    """Give rows without a region the region named for their site in ``nearest`` (site_id, region_code).

    ``nearest`` may come from ``nearest_region`` or from outside.  Rows are never
    multiplied: of several offers for a site, or centroids for a code, the least stands.
    """
    located = region_centroids(regions, region_vertex).select(
        "region_code",
        F.struct(
            F.col("region_name"), F.col("x").alias("region_centroid_longitude"),
            F.col("y").alias("region_centroid_latitude"),
        ).alias("near"),
    )
    offers = (
        nearest.select("site_id", "region_code").join(located, "region_code")
        .groupBy("site_id").agg(F.min(F.struct("region_code", "near")).alias("offer"))
        .select("site_id", F.col("offer.near").alias("near"))
    )
    empty = F.col("region_name").isNull()
    filled = {c: F.when(empty, F.col(f"near.{c}")).otherwise(F.col(c)) for c in _REGION_COLUMNS}
    return wide.join(offers, "site_id", "left").select(*[filled.get(c, F.col(f"`{c}`")).alias(c) for c in wide.columns])


def wide_by_year(
    series: DataFrame,
    sites: DataFrame,
    survey_type: DataFrame,
    taxonomy: DataFrame,
    site_region: DataFrame,
    value: str = "mean_monthly_rr",
    years: Iterable[int] = WIDE_YEARS,
) -> DataFrame:
    """One row per taxon, site and region, one column per year with the mean of ``value``.

    Rows with a response variable, main range only.  Taxon, site and region names
    depend on the two ids, so the cross-tabulation groups by the ids alone, in one
    shuffle, and the names join the finished rows.
    """
    years = list(years)
    wide = (
        series.where(F.col("response_variable_type_id").isNotNull() & (F.col("range_id") == MAIN_RANGE))
        .groupBy("taxon_id", "site_id")
        .agg(*[mean_where(F.col(value), F.col("year") == y).alias(str(y)) for y in years])
    )
    types = survey_type.select(F.col("id").alias("site_type"), F.col("name").alias("search_type_desc"))
    places = sites.select("site_id", "site_type", "site_permutation").join(types, "site_type")
    located = site_region.select(
        "site_id", "region_name",
        F.col("x").alias("region_centroid_longitude"), F.col("y").alias("region_centroid_latitude"),
    )
    names = taxonomy.select("taxon_id", "taxon_scientific_name", "sp_id", "taxon_name")
    return (
        wide.join(places, "site_id")
        .join(names, "taxon_id", "left")
        .join(located, "site_id", "left")
        .select(
            "taxon_scientific_name", "sp_id", "taxon_id", "taxon_name", "site_id", "search_type_desc",
            "site_permutation", *_REGION_COLUMNS, *[f"`{y}`" for y in years],
        )
    )
