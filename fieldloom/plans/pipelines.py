"""The three workflows end to end, as lazily built stages.

A stage is a property and is planned once.  Where one result reads a stage more
than once, ``keep`` decides what happens to it: by default it is checkpointed in the
shared folder that the session names; ``stored_under`` writes it as a table.  A stage
asked for on its own is never kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame

from fieldloom.constants import CUT_YEAR, PRIOR_SOURCE, PRIOR_YEAR_AFTER, WIDE_YEARS, SurveyScope
from fieldloom.operators import editions, methods, monthly, regions, taxa, yearly
from fieldloom.operators.geo import CellLayer, Layer
from fieldloom.operators.simplify import simplify_rings
from fieldloom.session import cut_lineage
from fieldloom.sources.tables import write_table

Keep = Callable[[str, DataFrame], DataFrame]


def checkpointed(_name: str, df: DataFrame) -> DataFrame:
    return cut_lineage(df)


def stored_under(folder: str) -> Keep:
    """Keep each shared stage as a Parquet table ``folder/<stage>``."""
    return lambda name, df: write_table(df, f"{folder}/{name}")


@dataclass(frozen=True)
class SurveyInputs:
    survey: DataFrame
    survey_point: DataFrame
    sighting: DataFrame
    site: DataFrame
    site_vertex: Layer
    taxonomy: DataFrame
    taxon_range_link: DataFrame
    range_vertex: DataFrame
    #: the dissolved ranges, where they are stored as a layer
    range_layer: CellLayer | None = None


class SeriesBuild:
    """Raw surveys and sightings to yearly series per site, taxon and range.

    With ``merge`` the parts of a range are made one.  With a ``tolerance`` above 0 the
    outlines that sites meet are simplified, after that; without ``merge`` each part for
    itself.  ``strict`` is that of the rates.
    """

    def __init__(self, inputs: SurveyInputs, scope: SurveyScope = SurveyScope(), keep: Keep = checkpointed,
                 tolerance: float = 0, strict: bool = False, merge: bool = False):
        self.inputs, self.scope, self.keep = inputs, scope, keep
        self.tolerance, self.strict, self.merge = tolerance, strict, merge

    @cached_property
    def ranges(self) -> DataFrame:
        dissolved = taxa.dissolve_ranges(self.inputs.range_vertex, self.inputs.taxon_range_link, self.inputs.taxonomy)
        if self.merge:
            dissolved = taxa.merged_ranges(dissolved, keep=self.keep)
        return simplify_rings(dissolved, taxa.RANGE_KEYS, self.tolerance)

    @cached_property
    def focal_species(self) -> DataFrame:
        return self.inputs.taxonomy.where("focal IS NOT NULL").select("sp_id").distinct()

    @cached_property
    def centroids(self) -> DataFrame:
        return taxa.site_centroids(self.inputs.site, self.inputs.site_vertex)

    @cached_property
    def _kept_ranges(self) -> DataFrame:
        return self.keep("taxon_ranges", self.ranges)

    @cached_property
    def sites_in_ranges(self) -> DataFrame:
        stored = self.inputs.range_layer if self.tolerance == 0 and not self.merge else None
        return taxa.sites_in_ranges(self.centroids, stored or self._kept_ranges)

    @cached_property
    def places(self) -> DataFrame:
        return monthly.sites_at_places(self.inputs.survey_point, self.inputs.site, self.inputs.site_vertex)

    @cached_property
    def _kept_places(self) -> DataFrame:
        return self.keep("sites_at_places", self.places)

    def _surveys(self, places: DataFrame, located: DataFrame) -> DataFrame:
        scope = replace(self.scope, survey_types=None)
        return monthly.surveys_by_month(self.inputs.survey, self.inputs.survey_point, places, located, scope)

    def _sightings(self, places: DataFrame, located: DataFrame, ranges: DataFrame | None) -> DataFrame:
        i = self.inputs
        return monthly.sightings_by_month(
            i.survey, i.sighting, i.survey_point, places, located, self.focal_species, ranges, self.scope
        )

    @cached_property
    def surveys_by_month(self) -> DataFrame:
        return self._surveys(self._kept_places, self.sites_in_ranges)

    def sightings_in_sites(self, sighting_id: str = "id") -> DataFrame:
        i = self.inputs
        return monthly.sightings_in_sites(
            i.survey, i.sighting, i.survey_point, self.places, self.sites_in_ranges, self.focal_species, self.scope,
            sighting_id,
        )

    @cached_property
    def sightings_by_month(self) -> DataFrame:
        return self._sightings(self._kept_places, self.sites_in_ranges, self._kept_ranges)

    @cached_property
    def data_by_month(self) -> DataFrame:
        places = self._kept_places
        located = self.keep("sites_in_ranges", self.sites_in_ranges)
        # sightings of taxa off their range would meet no survey row, so they are not made
        return monthly.data_by_month(
            self._surveys(places, located), self._sightings(places, located, None), self.inputs.site, self.strict
        )

    @cached_property
    def data_by_year(self) -> DataFrame:
        """Yearly series from monthly counts; ``yearly.data_by_year(self.data_by_month)`` gives the same."""
        i = self.inputs
        places = self._kept_places
        surveys = monthly.surveys_per_site(i.survey, i.survey_point, places, replace(self.scope, survey_types=None))
        sightings = monthly.sightings_per_site(
            i.survey, i.sighting, i.survey_point, places, self.focal_species, self.scope, self.sites_in_ranges
        )
        counted = self.keep("surveys_per_site", surveys)
        return yearly.data_by_year_from_counts(counted, sightings, self.sites_in_ranges, i.site, self.strict)

    def flagged(self, processing_method: DataFrame) -> DataFrame:
        """Yearly series with response variable and all-zero flag."""
        series = self.keep("data_by_year", self.data_by_year)
        assigned = yearly.assign_response_variable(series, processing_method)
        return yearly.flag_all_zero(assigned, "mean_monthly_rr")


class WideBuild:
    """Yearly series to the one-column-per-year table, every site with a region."""

    def __init__(self, series: DataFrame, site: DataFrame, site_vertex: Layer, survey_type: DataFrame,
                 taxonomy: DataFrame, region: DataFrame, region_vertex: Layer,
                 years: Iterable[int] = WIDE_YEARS, keep: Keep = checkpointed):
        self.series, self.site, self.survey_type, self.taxonomy = series, site, survey_type, taxonomy
        self.region, self.region_vertex, self.years, self.keep = region, region_vertex, list(years), keep
        self.centroids = taxa.site_centroids(site, site_vertex)

    @cached_property
    def site_region(self) -> DataFrame:
        return regions.site_region(self.centroids, self.region, self.region_vertex)

    @cached_property
    def nearest(self) -> DataFrame:
        return self._nearest(self.site_region)

    def _nearest(self, located: DataFrame) -> DataFrame:
        return regions.nearest_region(self.centroids, located, self.region, self.region_vertex)

    def _wide(self, value: str, located: DataFrame) -> DataFrame:
        return regions.wide_by_year(
            self.series, self.site, self.survey_type, self.taxonomy, located, value, self.years
        )

    def wide(self, value: str = "mean_monthly_rr") -> DataFrame:
        return self._wide(value, self.site_region)

    def filled(self, value: str = "mean_monthly_rr", nearest: DataFrame | None = None) -> DataFrame:
        """The wide table with a region on every row, the nearest one computed or as given."""
        if nearest is not None:
            return regions.fill_nearest_region(self.wide(value), nearest, self.region, self.region_vertex)
        located = self.keep("site_region", self.site_region)
        return regions.fill_nearest_region(
            self._wide(value, located), self._nearest(located), self.region, self.region_vertex
        )


class EditionComparison:
    """Current series against the prior edition."""

    def __init__(self, series: DataFrame, prior_raw: DataFrame, site: DataFrame, site_vertex: Layer,
                 taxonomy: DataFrame, survey_type: DataFrame, before: int = CUT_YEAR,
                 prior_after: int = PRIOR_YEAR_AFTER, prior_source: int = PRIOR_SOURCE, keep: Keep = checkpointed):
        self.series, self.prior_raw, self.site, self.site_vertex = series, prior_raw, site, site_vertex
        self.taxonomy, self.survey_type, self.keep = taxonomy, survey_type, keep
        self.before, self.prior_after, self.prior_source = before, prior_after, prior_source

    @cached_property
    def prior(self) -> DataFrame:
        loaded = editions.load_prior_edition(self.prior_raw, self.prior_source)
        return editions.back_attribute_sites(loaded, self.site, self.site_vertex)

    @cached_property
    def prior_flagged(self) -> DataFrame:
        return yearly.flag_all_zero(self.prior, "value", ["taxon_id", "site_id", "search_type_id"])

    @cached_property
    def current(self) -> DataFrame:
        """Current series with the all-zero flag and the answer to "does it differ?"."""
        flagged = yearly.flag_all_zero(self.series, "mean_monthly_rr")
        return editions.flag_value_differs(flagged, self.prior, self.prior_after)

    @cached_property
    def summaries(self) -> DataFrame:
        return editions.compare_edition_summaries(
            editions.current_edition_summary(self.series, self.taxonomy, self.before),
            editions.prior_edition_summary(self.prior, self.taxonomy),
        )

    @cached_property
    def difference_counts(self) -> DataFrame:
        return editions.value_difference_counts(self.current, self.taxonomy, self.survey_type, self.before)

    @cached_property
    def current_series(self) -> DataFrame:
        return editions.current_series_summary(self.series, self.site, self.survey_type, self.before)

    @cached_property
    def prior_series(self) -> DataFrame:
        return editions.prior_series_summary(self.prior, self.site, self.survey_type, self.before)

    @cached_property
    def _kept_series(self) -> tuple[DataFrame, DataFrame]:
        return (
            self.keep("current_series_summary", self.current_series),
            self.keep("prior_series_summary", self.prior_series),
        )

    @cached_property
    def non_matching(self) -> DataFrame:
        return editions.non_matching_series(*self._kept_series, self.taxonomy)

    @cached_property
    def qualifying_statistics(self) -> DataFrame:
        return editions.qualifying_series_statistics(*self._kept_series, self.non_matching, self.taxonomy)

    @cached_property
    def pairs(self) -> DataFrame:
        return editions.edition_pairs(self.series, self.prior, self.prior_after)


def method_table(direct: DataFrame, linked: DataFrame, previous: DataFrame, taxon: DataFrame,
                 count_sources: Iterable[int], keep: Keep = checkpointed) -> DataFrame:
    """Profiles of both data types, classified, with orphans and the previous variable."""
    current = keep("method_profiles", methods.append_profiles(direct, linked))
    current = methods.classify_response_variable(current, count_sources)
    orphans = methods.orphan_methods(previous, current, taxon)
    return methods.attach_previous_method(methods.append_profiles(current, orphans), previous)
