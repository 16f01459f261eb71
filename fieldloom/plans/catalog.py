"""Named queries over the star-schema test tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.constants import SurveyScope
from fieldloom.functions import projection
from fieldloom.operators import editions, export, geo, methods, monthly, overlay, quality, regions, taxa, yearly
from fieldloom.operators.simplify import simplify_rings
from fieldloom.plans.pipelines import (
    EditionComparison,
    Keep,
    SeriesBuild,
    SurveyInputs,
    WideBuild,
    checkpointed,
    method_table,
)
from fieldloom.session import shared_folder
from fieldloom.sources import stored
from fieldloom.sources.star import StarTables
from fieldloom.sources.tables import save_bucketed, write_table

# parameters that fit the years and codes of the test tables
SCOPE = SurveyScope("1995-02-01", "2001-06-30", (3, 7, 11), (1, 2))
YEARS = range(1995, 2002)
CUT_YEAR = 2001
PRIOR_AFTER = 1995
MIN_YEARS = 3
COUNT_SOURCES = (4, 8, 15)

DECIMALS = 6


def published(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, so that results do not hang on the order of a sum."""
    return df.select(
        *[
            F.round(f"`{f.name}`", DECIMALS).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


class Workload:
    """All stages over one set of tables."""

    def __init__(self, tables: StarTables, keep: Keep = checkpointed):
        self.t = tables
        self.keep = keep

    @cached_property
    def series(self) -> SeriesBuild:
        t = self.t
        inputs = SurveyInputs(
            t.survey, t.survey_point, t.sighting, t.site, t.layer("site_vertex"), t.taxonomy, t.taxon_range_link, t.range_vertex,
            t.layer("taxon_range"),
        )
        return SeriesBuild(inputs, SCOPE, self.keep)

    @cached_property
    def merged_ranges(self) -> DataFrame:
        return taxa.merged_ranges(self.series.ranges)

    @cached_property
    def assigned(self) -> DataFrame:
        return yearly.assign_response_variable(self.series.data_by_year, self.t.processing_method)

    @cached_property
    def flagged(self) -> DataFrame:
        return self.series.flagged(self.t.processing_method)

    @cached_property
    def comparison(self) -> EditionComparison:
        t = self.t
        return EditionComparison(
            t.edition_cur, t.edition_prev, t.site, t.layer("site_vertex"), t.taxonomy, t.survey_type, CUT_YEAR, PRIOR_AFTER,
            keep=self.keep,
        )

    def wide(self, series: DataFrame) -> WideBuild:
        t = self.t
        return WideBuild(
            series, t.site, t.layer("site_vertex"), t.survey_type, t.taxonomy, t.subregion, t.layer("subregion_vertex"), YEARS, self.keep
        )

    @cached_property
    def dims(self) -> export.Dimensions:
        t = self.t
        return export.Dimensions(
            t.taxon, t.taxon_group, t.taxon_status, t.search_type, t.source, t.unit, t.export_region,
            t.region_centroid, t.taxon_source_hull, t.data_source, t.t1_site, t.t2_site, t.management,
            t.monitoring_program, t.experimental_design_type, t.response_variable_type,
        )

    @cached_property
    def direct_profile(self) -> DataFrame:
        t = self.t
        return methods.method_profile_direct(t.source, t.t1_survey, t.t1_sighting, t.t1_site, t.taxon)

    @cached_property
    def linked_profile(self) -> DataFrame:
        t = self.t
        return methods.method_profile_linked(t.source, t.t2_survey, t.t2_sighting, t.t2_taxon_sighting, t.taxon)

    @cached_property
    def profiles(self) -> DataFrame:
        both = methods.append_profiles(self.direct_profile, self.linked_profile)
        return methods.classify_response_variable(both, COUNT_SOURCES)

    @cached_property
    def method_table(self) -> DataFrame:
        return method_table(
            self.direct_profile, self.linked_profile, self.t.processing_method, self.t.taxon, COUNT_SOURCES, self.keep
        )

    @cached_property
    def qualifying(self) -> DataFrame:
        t = self.t
        return export.qualifying_time_series(t.agg, t.taxon, t.data_source, YEARS[0], YEARS[-1], MIN_YEARS)

    @cached_property
    def pairs(self) -> DataFrame:
        return self.comparison.pairs

    @cached_property
    def edition_rates(self) -> DataFrame:
        return self.t.edition_cur.withColumnRenamed("mean_monthly_rr", "rr")


def _included(w: Workload) -> DataFrame:
    flagged = export.flag_include_in_analysis(w.t.agg, w.t.data_source, w.qualifying, YEARS[0], YEARS[-1])
    return flagged.select("time_series_id", "start_date_y", "include_in_analysis")


def _included_two_rows(w: Workload) -> DataFrame:
    second = w.t.data_source.withColumn("start_year", F.when(F.col("source_id") % 3 != 1, F.lit(1997))).withColumn(
        "end_year", F.lit(1999)
    )
    twice = w.t.data_source.unionByName(second)
    flagged = export.flag_include_in_analysis(w.t.agg, twice, w.qualifying, YEARS[0], YEARS[-1])
    return flagged.select("time_series_id", "start_date_y", "include_in_analysis")


def _listed_twice(w: Workload) -> DataFrame:
    again = w.t.focal_list.join(w.t.taxonomy.select("taxon_id", "sp_id"), "taxon_id").select(
        "taxon_id", (F.col("sp_id") % 3).cast("int").alias("focal")
    )
    return taxa.flag_focal_taxa(w.t.taxonomy, w.t.focal_list.unionByName(again))


def _exported(w: Workload) -> DataFrame:
    return export.time_series_export(w.t.agg_export, w.dims, YEARS[0], YEARS[-1])


def _export(w: Workload) -> DataFrame:
    return _exported(w).drop("values_by_year")


def _values_by_year(w: Workload) -> DataFrame:
    return _exported(w).select("time_series_id", "data_type", F.explode("values_by_year").alias("year", "value"))


def _filled_two_offers(w: Workload) -> DataFrame:
    wide = w.wide(w.t.edition_cur)
    given = wide.nearest.select("site_id", F.explode(F.array("region_code", F.lit("R12"))).alias("region_code"))
    return wide.filled("mean_monthly_rr", given)


def _absences(w: Workload) -> DataFrame:
    t = w.t
    return export.implied_absences(
        t.t2_survey, t.t2_survey_site, t.t2_processed_survey, t.taxon_site, t.t2_processed_sighting
    )


def _described_series(w: Workload) -> DataFrame:
    t = w.t
    lookups = {
        "search_type": (t.search_type, "search_type_id", "description"),
        "experimental_design_type": (t.experimental_design_type, "experimental_design_type_id", "description"),
        "response_variable_type": (t.response_variable_type, "response_variable_type_id", "description"),
    }
    return export.with_descriptions(t.agg, lookups).select(
        "time_series_id", "start_date_y", "search_type", "experimental_design_type", "response_variable_type"
    )


def _named_sites(w: Workload) -> DataFrame:
    named = export.with_site_names(w.t.agg_export, w.t.t1_site, w.t.t2_site)
    return named.select("time_series_id", "start_date_y", "data_type", "site_or_cell_id", "site_name")


def _represented(w: Workload) -> DataFrame:
    shares = export.with_spatial_representativeness(w.t.agg_export, w.t.taxon, w.t.taxon_source_hull)
    return shares.select("time_series_id", "start_date_y", "data_type", "spatial_representativeness")


def _place(w: Workload, name: str) -> str:
    """A new folder for a stored table, where all machines see it."""
    return f"{shared_folder(w.t.spark)}/{name}-{uuid.uuid4().hex}"


def _updated_in_place(w: Workload) -> DataFrame:
    """The yearly series stored by year, then told which of them are all zero by an update."""
    path, spark = _place(w, "data_by_year"), w.t.spark
    keys = ["taxon_id", "site_id", "survey_type_id", "year"]
    bare = w.assigned.withColumn("all0_values", F.lit(None).cast("smallint"))
    series = write_table(bare, path, partition_by=["year"]).select(*bare.columns)
    zeros = yearly.flag_all_zero(series, "mean_monthly_rr").where("all0_values = 1").select(*keys, "all0_values").distinct()
    stored.update_table(spark, path, ["year"], keys, w.keep("all_zero_keys", zeros))
    return spark.read.schema(bare.schema).parquet(path).select(*bare.columns)


def _appended_to_table(w: Workload) -> DataFrame:
    """Profiles of the first data type as a keyed table, those of the second appended under its key."""
    name = f"method_profiles_{uuid.uuid4().hex}"
    keys = ["taxon_id", "unit_id", "unit_type_id", "source_id", "search_type_id", "data_type"]
    first, second = (methods.append_profiles(p) for p in (w.direct_profile, w.linked_profile))
    save_bucketed(first, name, ["taxon_id", "source_id"], 8, _place(w, "method_profiles"))
    return stored.append_keyed(w.keep("linked_profiles", second), name, keys, 8, allow_null=True)


def _replaced_whole(w: Workload) -> DataFrame:
    """The monthly table put in the place of an earlier one."""
    folder, months = _place(w, "data_by_month"), w.series.data_by_month
    stored.replace_table(months.where("year < 1997"), folder)
    table = stored.replace_table(months, folder)
    stored.drop_old_versions(w.t.spark, folder)
    return table


def _projected(w: Workload) -> DataFrame:
    """Site centroids in metres, and back in degrees."""
    there = projection.transform(geo.with_srid(w.series.centroids.select("site_id", "x", "y"), 4283), 3112)
    back = projection.transform(there.withColumns({"east": F.round("x", 2), "north": F.round("y", 2)}), 4283)
    return back.select("site_id", "east", "north", F.col("x").alias("lon"), F.col("y").alias("lat"))


def _report(w: Workload) -> DataFrame:
    t = w.t
    return methods.method_report(
        w.method_table, t.taxon, t.search_type, t.unit, t.unit_type, t.source, t.taxon_status
    )


def _by_region(w: Workload) -> DataFrame:
    located = w.wide(w.t.edition_cur).site_region.select("site_id", "region_name")
    return editions.rate_by_factor(w.pairs.join(located, "site_id", "left"), ["region_name", "search_type_id"])


def _simplified(w: Workload, outlines: str = "range_vertex_dense") -> DataFrame:
    ranges = taxa.dissolve_ranges(w.t[outlines], w.t.taxon_range_link, w.t.taxonomy)
    return simplify_rings(ranges, taxa.RANGE_KEYS)


def _filled_from_table(w: Workload) -> DataFrame:
    wide = w.wide(w.t.edition_cur)
    given = wide.nearest.select("site_id", F.upper("region_code").alias("region_code"))
    return wide.filled("monthly_mean_abundance", given)


QUERIES: dict[str, Callable[[Workload], DataFrame]] = {
    # taxa, ranges, sites
    "focal_taxa_listed_twice": _listed_twice,
    "focal_taxa": lambda w: taxa.flag_focal_taxa(w.t.taxonomy, w.t.focal_list),
    "taxon_ranges": lambda w: w.series.ranges,
    "merged_range_corners": lambda w: w.merged_ranges.select(*taxa.RANGE_KEYS, "x", "y").distinct(),
    "merged_range_measures": lambda w: overlay.outline_measures(w.merged_ranges, taxa.RANGE_KEYS),
    "simplified_ranges": _simplified,
    "simplified_bent_ranges": lambda w: _simplified(w, "range_vertex_bent"),
    "site_centroids": lambda w: w.series.centroids,
    "sites_in_ranges": lambda w: w.series.sites_in_ranges,
    "sites_in_ranges_outlines": lambda w: taxa.sites_with_geometry(w.series.sites_in_ranges, w.t.site_vertex),
    # keys
    "key_violations_sites_in_ranges": lambda w: quality.unique_key_violations(
        w.series.sites_in_ranges, ["site_id", "taxon_id"]
    ),
    "key_violations_taxon_ranges": lambda w: quality.unique_key_violations(
        w.series.ranges, ["taxon_id", "range_id", "part", "ring", "seq"]
    ),
    # a taxon with two source ranges has two parts in a range class until they are merged
    "key_violations_range_parts": lambda w: quality.unique_key_violations(
        w.series.ranges.select("taxon_id", "range_id", "part").distinct(), ["taxon_id", "range_id"]
    ),
    # sites in several range classes of a taxon
    "key_violations_data_by_month_taxon": lambda w: quality.unique_key_violations(
        w.series.data_by_month, ["site_id", "taxon_id", "year", "month"]
    ),
    "key_violations_surveys_by_month": lambda w: quality.unique_key_violations(
        w.series.surveys_by_month, ["site_id", "taxon_id", "year", "month"]
    ),
    "key_violations_data_by_month": lambda w: quality.unique_key_violations(
        w.series.data_by_month, ["site_id", "taxon_id", "range_id", "year", "month"]
    ),
    "key_violations_method_profiles": lambda w: quality.unique_key_violations(
        w.profiles, ["taxon_id", "unit_id", "source_id", "search_type_id", "data_type"], allow_null=True
    ),
    "key_violations_previous_methods": lambda w: quality.unique_key_violations(
        w.t.processing_method, ["taxon_id", "unit_id", "source_id", "search_type_id"]
    ),
    # monthly facts
    "valid_surveys": lambda w: monthly.valid_surveys(w.t.survey, SCOPE),
    "surveys_by_month": lambda w: w.series.surveys_by_month,
    "sightings_in_sites": lambda w: w.series.sightings_in_sites("line"),
    "taxon_sightings": lambda w: monthly.taxon_sightings(w.series.sightings_in_sites("line"), w.series.ranges),
    "sightings_by_month": lambda w: w.series.sightings_by_month,
    "data_by_month": lambda w: w.series.data_by_month,
    "coverage_species": lambda w: taxa.taxon_coverage(w.series.sightings_in_sites("line"), "sp_id"),
    "coverage_taxa": lambda w: taxa.taxon_coverage(w.series.sightings_by_month, "taxon_id"),
    "distinct_taxa": lambda w: taxa.distinct_taxa(w.series.data_by_month),
    # yearly series
    "data_by_year": lambda w: w.series.data_by_year,
    "data_by_year_from_months": lambda w: yearly.data_by_year(w.series.data_by_month),
    "response_variable": lambda w: w.assigned,
    "all_zero_series": lambda w: w.flagged,
    "site_count_summary": lambda w: yearly.site_count_summary(w.assigned, w.t.taxonomy, w.t.survey_type),
    "rate_and_abundance_length": lambda w: editions.rate_and_abundance_length(w.series.data_by_year),
    # edition comparison
    "prior_edition": lambda w: editions.load_prior_edition(w.t.edition_prev),
    "prior_points": lambda w: editions.point_from_lonlat(editions.load_prior_edition(w.t.edition_prev)),
    "prior_sites_attributed": lambda w: w.comparison.prior,
    "prior_all_zero_series": lambda w: w.comparison.prior_flagged,
    "prior_edition_summary": lambda w: editions.prior_edition_summary(w.comparison.prior, w.t.taxonomy),
    "current_edition_summary": lambda w: editions.current_edition_summary(w.t.edition_cur, w.t.taxonomy, CUT_YEAR),
    "distinct_sighting_sums": lambda w: editions.distinct_sighting_sums(w.t.edition_cur),
    "edition_summaries_compared": lambda w: w.comparison.summaries,
    "value_differs": lambda w: w.comparison.current,
    "value_difference_counts": lambda w: w.comparison.difference_counts,
    "current_series_summary": lambda w: w.comparison.current_series,
    "prior_series_summary": lambda w: w.comparison.prior_series,
    "non_matching_series": lambda w: w.comparison.non_matching,
    "qualifying_series_statistics": lambda w: w.comparison.qualifying_statistics,
    "edition_pairs": lambda w: w.pairs,
    "rate_delta": lambda w: editions.with_rate_delta(w.pairs),
    "aggregated_deltas": lambda w: editions.aggregated_deltas(w.pairs),
    "mean_yearly_rate": lambda w: editions.mean_yearly_rate(w.pairs, CUT_YEAR),
    "unmatched_sites": lambda w: editions.unmatched_sites(w.series.data_by_year, w.comparison.prior),
    "differing_months": lambda w: editions.differing_months(w.comparison.current, w.series.data_by_month),
    "rate_by_search_type_and_year": lambda w: editions.rate_by_factor(w.pairs, ["search_type_id", "year"]),
    "rate_by_factor_cube": lambda w: editions.rate_by_factor(w.pairs, ["search_type_id", "prior_source"], cube=True),
    "rate_by_region": _by_region,
    "edition_wide": lambda w: editions.edition_wide(w.edition_rates, w.t.survey_type, "rr", YEARS),
    "edition_long": lambda w: editions.edition_long(w.edition_rates, w.t.survey_type),
    # regions and the wide table
    "region_centroids": lambda w: regions.region_centroids(w.t.subregion, w.t.subregion_vertex),
    "site_region": lambda w: w.wide(w.t.edition_cur).site_region,
    "site_region_lowest": lambda w: regions.site_region(
        w.series.centroids, w.t.subregion, w.t.subregion_vertex, pick="min"
    ),
    "regions_near_sites": lambda w: geo.polygons_within(
        w.series.centroids, w.t.layer("subregion_vertex"), "site_id", "region_id", 3.0
    ),
    "projected_sites": _projected,
    "nearest_region": lambda w: w.wide(w.t.edition_cur).nearest,
    "wide_reporting_rate": lambda w: w.wide(w.assigned).wide(),
    "wide_mean_abundance": lambda w: w.wide(w.assigned).wide("monthly_mean_abundance"),
    "wide_reporting_rate_filled": lambda w: w.wide(w.t.edition_cur).filled(),
    "wide_filled_from_table": _filled_from_table,
    "wide_filled_two_offers": _filled_two_offers,
    # export
    "time_series_export": _export,
    "export_values_by_year": _values_by_year,
    "functional_groups": lambda w: export.functional_groups(w.t.taxon_group),
    "described_series": _described_series,
    "site_names": _named_sites,
    "spatial_representativeness": _represented,
    "taxonomic_class": lambda w: export.with_taxonomic_class(w.t.taxon).select(
        "id", "taxonomic_group", "taxonomic_class"
    ),
    "implied_absences": _absences,
    "qualifying_time_series": lambda w: w.qualifying,
    "include_in_analysis": _included,
    "include_in_analysis_two_rows": _included_two_rows,
    # stored tables
    "all_zero_updated_in_place": _updated_in_place,
    "method_profiles_appended_to_table": _appended_to_table,
    "data_by_month_replaced": _replaced_whole,
    # processing methods
    "method_profile_direct": lambda w: w.direct_profile,
    "method_profile_linked": lambda w: w.linked_profile,
    "method_profiles_appended": lambda w: methods.append_profiles(w.direct_profile, w.linked_profile),
    "response_variable_classified": lambda w: w.profiles,
    "orphan_methods": lambda w: methods.orphan_methods(w.t.processing_method, w.profiles, w.t.taxon),
    "orphan_methods_null_safe": lambda w: methods.orphan_methods(
        w.t.processing_method, w.profiles, w.t.taxon, null_safe=True
    ),
    "previous_method": lambda w: w.method_table,
    "method_report": _report,
}


def run_on(name: str, tables: StarTables) -> DataFrame:
    return published(QUERIES[name](Workload(tables)))


def run(name: str, spark: SparkSession, directory: str) -> DataFrame:
    """A query over the given tables, with the survey tables derived on the way."""
    return run_on(name, StarTables(spark, directory))
