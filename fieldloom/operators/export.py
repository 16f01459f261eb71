"""Denormalised time series for the index, and the filter that selects them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom import constants as c
from fieldloom.functions import labels


@dataclass(frozen=True)
class Dimensions:
    """The lookup tables of an export."""

    taxon: DataFrame
    taxon_group: DataFrame
    taxon_status: DataFrame
    search_type: DataFrame
    source: DataFrame
    unit: DataFrame
    region: DataFrame
    region_centroid: DataFrame
    hull: DataFrame
    data_source: DataFrame
    t1_site: DataFrame
    t2_site: DataFrame
    management: DataFrame
    monitoring_program: DataFrame
    experimental_design_type: DataFrame
    response_variable_type: DataFrame


def with_taxonomic_class(taxon: DataFrame, group: str = "taxonomic_group") -> DataFrame:
    """Add ``taxonomic_class``."""
    return taxon.withColumn("taxonomic_class", labels.taxonomic_class(F.col(group)))


def functional_groups(taxon_group: DataFrame) -> DataFrame:
    """The groups of each taxon as one comma list, sorted."""
    label = labels.group_label(F.col("group_name"), F.col("subgroup_name"))
    return (
        taxon_group.select("taxon_id", label.alias("label"))
        .groupBy("taxon_id")
        .agg(F.array_join(F.array_sort(F.collect_list("label")), ",").alias("functional_group"))
    )


def with_descriptions(df: DataFrame, lookups: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Resolve ids to text: ``{new column: (lookup, id column of df, text column of the lookup)}``.

    A lookup is reduced to one row per id, so it can never repeat a row.
    """
    for label, (lookup, key, text) in lookups.items():
        texts = lookup.groupBy(F.col("id").alias(key)).agg(F.min(text).alias(label))
        df = df.join(texts, key, "left")
    return df


def _place_key(df: DataFrame) -> Column:
    """``site_id`` as a join key: rows without a site get keys that no site has, dealt over many tasks.

    Site ids are not negative; joined as NULL, such rows would all meet in one task.
    """
    spread = [c for c in ("grid_cell_id", "taxon_id", "source_id") if c in df.columns]
    return F.coalesce(F.col("site_id").cast("long"), -1 - F.pmod(F.xxhash64(*spread), F.lit(1 << 20)))


def with_site_names(agg: DataFrame, t1_site: DataFrame, t2_site: DataFrame) -> DataFrame:
    """Add ``site_or_cell_id`` and ``site_name``; each site table names the sites of its own data type."""
    def named(sites: DataFrame, data_type: int) -> DataFrame:
        key = F.col("id").cast("long").alias("_place")
        return sites.select(key, F.lit(data_type).alias("data_type"), F.col("name").alias("_name"))

    sites = named(t1_site, 1).unionByName(named(t2_site, 2))
    first, second = (F.when(F.col("data_type") == n, F.col("_name")) for n in (1, 2))
    name = labels.site_name(first, second, F.col("data_type"), F.col("site_id"), F.col("grid_cell_id"))
    return (
        agg.withColumn("_place", _place_key(agg))
        .join(sites, ["_place", "data_type"], "left")
        .withColumn("site_or_cell_id", F.coalesce("site_id", "grid_cell_id"))
        .withColumn("site_name", name)
        .select(*agg.columns, "site_or_cell_id", "site_name")
    )


def with_spatial_representativeness(agg: DataFrame, taxon: DataFrame, hull: DataFrame) -> DataFrame:
    """Add ``spatial_representativeness`` by taxon, source and data type."""
    areas = hull.select("taxon_id", "source_id", "data_type", "alpha_hull_area_in_m2", "core_range_area_in_m2")
    flags = taxon.select(F.col("id").alias("taxon_id"), "suppress_spatial_representativeness")
    share = labels.spatial_representativeness(
        F.col("suppress_spatial_representativeness"), F.col("alpha_hull_area_in_m2"), F.col("core_range_area_in_m2")
    )
    return (
        agg.join(flags, "taxon_id")
        .join(areas, ["taxon_id", "source_id", "data_type"], "left")
        .withColumn("spatial_representativeness", share)
        .drop("suppress_spatial_representativeness", "alpha_hull_area_in_m2", "core_range_area_in_m2")
    )


EXPORT_KEYS = [
    "source_id", "search_type_id", "site_id", "grid_cell_id", "experimental_design_type_id",
    "response_variable_type_id", "region_id", "unit_id", "data_type",
]


def time_series_export(
    agg: DataFrame,
    dims: Dimensions,
    min_year: int,
    max_year: int,
    taxon_id: str | None = None,
    where: Column | None = None,
    having: Column | None = None,
) -> DataFrame:
    """One row per time series with its values packed by year and everything known about it.

    All taxa at once, or one ``taxon_id``.  ``where`` filters the yearly rows,
    ``having`` the finished series.  ``values_by_year`` is the map year -> value,
    ``value_series`` the same as text ``year=value,…`` in order of year, an unknown
    value as ``NA``, so the text has an entry for each year.

    The facts are grouped by their own ids first, by year and then by series, so a
    packed list holds no more entries than there are years (a year with several
    rows shows their mean).  Every name joins the result, one row per series, so
    the lookups never see the yearly rows.
    """
    rows = agg.where(F.col("start_date_y").between(min_year, max_year))
    if taxon_id is not None:
        rows = rows.where(F.col("taxon_id") == taxon_id)
    if where is not None:
        rows = rows.where(where)
    yearly = rows.groupBy("taxon_id", *EXPORT_KEYS, "start_date_y").agg(
        F.min("time_series_id").alias("time_series_id"),
        F.avg("value").alias("value"),
        F.count("*").alias("n"),
        F.max("centroid_x").alias("centroid_x"),
        F.max("centroid_y").alias("centroid_y"),
        F.max("positional_accuracy_in_m").alias("positional_accuracy_in_m"),
        F.sum("survey_count").alias("survey_count"),
    )
    packed = F.array_sort(F.collect_list(F.struct(F.col("start_date_y").alias("year"), "value")))
    series = yearly.groupBy("taxon_id", *EXPORT_KEYS).agg(
        F.min("time_series_id").alias("time_series_id"),
        packed.alias("packed"),
        F.sum("n").alias("value_count"),
        F.max("centroid_x").alias("surveys_centroid_longitude"),
        F.max("centroid_y").alias("surveys_centroid_latitude"),
        F.max("positional_accuracy_in_m").alias("surveys_spatial_accuracy"),
        F.sum("survey_count").alias("survey_count"),
    )
    if having is not None:
        series = series.where(having)

    centroid = dims.region_centroid.groupBy(F.col("id").alias("region_id")).agg(
        F.min("x").alias("region_centroid_longitude"), F.min("y").alias("region_centroid_latitude")
    )
    region = dims.region.select(
        F.col("id").alias("region_id"), F.col("name").alias("region"), "state",
        F.col("positional_accuracy_in_m").alias("region_centroid_accuracy"),
    )
    taxon = with_descriptions(
        with_taxonomic_class(dims.taxon).withColumnRenamed("id", "taxon_id"),
        {
            "epbc_status": (dims.taxon_status, "epbc_status_id", "description"),
            "iucn_status": (dims.taxon_status, "iucn_status_id", "description"),
            "state_plant_status": (dims.taxon_status, "state_status_id", "description"),
            "bird_action_plan_status": (dims.taxon_status, "bird_action_plan_status_id", "description"),
            "max_status": (dims.taxon_status, "max_status_id", "description"),
        },
    ).join(functional_groups(dims.taxon_group), "taxon_id", "left")
    taxon = taxon.select(
        "taxon_id", "spno", "common_name", "taxon_order", "scientific_name",
        F.col("family_scientific_name").alias("family"), "family_common_name", "functional_group", "taxonomic_group",
        "taxonomic_class", F.col("national_priority").alias("national_priority_taxa"), "epbc_status", "iucn_status",
        "state_plant_status", "bird_action_plan_status", "max_status",
    )
    source = with_descriptions(
        dims.source.select(F.col("id").alias("source_id"), F.col("description").alias("source_desc"),
                           "monitoring_program_id"),
        {"monitoring_program": (dims.monitoring_program, "monitoring_program_id", "description")},
    ).drop("monitoring_program_id")
    unit = dims.unit.select(F.col("id").alias("unit_id"), F.col("description").alias("unit"))
    # the search type's own id is shown, so an unknown one shows as NULL
    search = dims.search_type.select(
        F.col("id").alias("search_type_id"), F.col("id").alias("_known"), F.col("description").alias("search_type_desc")
    )
    site = with_descriptions(
        dims.t1_site.select(F.col("id").cast("long").alias("_place"), F.lit(1).alias("data_type"), "management_id",
                            F.col("management_comments").alias("management_category_comments")),
        {
            "management": (dims.management, "management_id", "type"),
            "management_category": (dims.management, "management_id", "description"),
        },
    ).drop("management_id")
    quality = dims.data_source.select(
        "taxon_id", "source_id", "absences_recorded",
        F.col("standardisation_of_method_effort_id").alias("standardisation_of_method_effort"),
        F.col("objective_of_monitoring_id").alias("objective_of_monitoring"),
        F.col("consistency_of_monitoring_id").alias("consistency_of_monitoring"),
        F.col("data_agreement_id").alias("data_agreement"), "suppress_aggregated_data", "citation",
    )
    named = with_site_names(series, dims.t1_site, dims.t2_site).withColumn("_place", _place_key(series))
    named = with_spatial_representativeness(named, dims.taxon, dims.hull)
    named = with_descriptions(
        named,
        {
            "experimental_design_type": (dims.experimental_design_type, "experimental_design_type_id", "description"),
            "response_variable_type": (dims.response_variable_type, "response_variable_type_id", "description"),
        },
    )
    shown = lambda v: F.coalesce(v.cast("string"), F.lit(c.UNKNOWN_VALUE))
    as_text = F.transform("packed", lambda p: F.concat(p["year"].cast("string"), F.lit("="), shown(p["value"])))
    return (
        named.join(taxon, "taxon_id")
        .join(source, "source_id")
        .join(unit, "unit_id")
        .join(search, "search_type_id", "left")
        .join(region, "region_id", "left")
        .join(centroid, "region_id", "left")
        .join(site, ["_place", "data_type"], "left")
        .join(quality, ["taxon_id", "source_id"], "left")
        .orderBy("taxon_id", *EXPORT_KEYS)
        .select(
            "time_series_id", "spno", "taxon_id", "common_name", "taxon_order", "scientific_name", "family",
            "family_common_name", "functional_group", "taxonomic_group", "taxonomic_class", "national_priority_taxa",
            "epbc_status", "iucn_status", "state_plant_status", "bird_action_plan_status", "max_status",
            F.col("_known").alias("search_type_id"), "search_type_desc",
            F.col("site_or_cell_id").alias("site_id"), "site_name",
            F.coalesce("management", F.lit(c.NO_MANAGEMENT)).alias("management"),
            F.coalesce("management_category", F.lit(c.NO_MANAGEMENT_CATEGORY)).alias("management_category"),
            "management_category_comments", "source_id", "source_desc", "monitoring_program", "unit_id", "unit",
            "region", "state", "region_centroid_longitude", "region_centroid_latitude", "region_centroid_accuracy",
            F.map_from_entries("packed").alias("values_by_year"),
            F.array_join(as_text, ",").alias("value_series"), "value_count", "data_type", "experimental_design_type",
            "response_variable_type", "spatial_representativeness", "absences_recorded",
            "standardisation_of_method_effort", "objective_of_monitoring", "consistency_of_monitoring",
            "data_agreement", "suppress_aggregated_data", "surveys_centroid_longitude", "surveys_centroid_latitude",
            "surveys_spatial_accuracy", "survey_count", "citation",
        )
    )


def implied_absences(
    survey: DataFrame,
    survey_site: DataFrame,
    processed_survey: DataFrame,
    taxon_site: DataFrame,
    processed_sighting: DataFrame,
    taxon_id: str | None = None,
) -> DataFrame:
    """Standardised surveys at a site where a taxon is expected, without a record of it.

    All taxa at once, or one ``taxon_id``: processed survey id and taxon.
    """
    expected = taxon_site if taxon_id is None else taxon_site.where(F.col("taxon_id") == taxon_id)
    sites = survey_site.join(survey.select(F.col("id").alias("survey_id")), "survey_id", "left_semi")
    standard = processed_survey.where(F.col("experimental_design_type_id") == c.SITE_DESIGN).select(
        F.col("id").alias("processed_survey_id"), F.col("raw_survey_id").alias("survey_id")
    )
    seen = processed_sighting.select(F.col("survey_id").alias("processed_survey_id"), "taxon_id")
    return (
        standard.join(sites.select("survey_id", "site_id"), "survey_id")
        .join(expected.select("site_id", "taxon_id"), "site_id")
        .join(seen, ["processed_survey_id", "taxon_id"], "left_anti")
        .select("processed_survey_id", "taxon_id")
    )


def _within_source_years(min_year: int, max_year: int) -> Column:
    return (F.col("start_date_y") <= F.coalesce("end_year", F.lit(max_year))) & (
        F.col("start_date_y") >= F.coalesce("start_year", F.lit(min_year))
    )


def qualifying_time_series(
    agg: DataFrame, taxon: DataFrame, data_source: DataFrame, min_year: int, max_year: int, min_years: int
) -> DataFrame:
    """Ids of the series fit for analysis.

    Years within the bounds of the source; quality scores, status and design pass;
    some value above 0; at least ``min_years`` distinct years.  An unknown score
    passes, an unknown status fails, and a series without source details is out.
    """

    def passes(column: str, failing: tuple[int, ...]) -> Column:
        return ~F.coalesce(F.col(column), F.lit(-1)).isin(*failing)

    details = data_source.select(
        "taxon_id", "source_id", "start_year", "end_year", "exclude_from_analysis", "data_agreement_id",
        "standardisation_of_method_effort_id", "consistency_of_monitoring_id",
    )
    statuses = taxon.select(F.col("id").alias("taxon_id"), "max_status_id")
    rows = (
        agg.where(
            (F.coalesce(F.col("search_type_id"), F.lit(0)) != c.INCIDENTAL_SEARCH)
            & F.col("region_id").isNotNull()
            & (F.col("experimental_design_type_id") == c.SITE_DESIGN)
        )
        .join(statuses, "taxon_id")
        .join(details, ["taxon_id", "source_id"], "left")
        .where(
            _within_source_years(min_year, max_year)
            & ~F.col("exclude_from_analysis")
            & ~F.coalesce(F.col("max_status_id"), F.lit(0)).isin(*c.FAILING_STATUSES)
            & passes("data_agreement_id", c.FAILING_AGREEMENTS)
            & passes("standardisation_of_method_effort_id", c.FAILING_STANDARDISATION)
            & passes("consistency_of_monitoring_id", c.FAILING_CONSISTENCY)
        )
    )
    # one row per series and year, then plain counts
    yearly = rows.groupBy("time_series_id", "start_date_y").agg(F.max("value").alias("value"))
    return (
        yearly.groupBy("time_series_id")
        .agg(F.max("value").alias("top"), F.count("start_date_y").alias("years"))
        .where((F.col("top") > 0) & (F.col("years") >= min_years))
        .select("time_series_id")
    )


def flag_include_in_analysis(
    agg: DataFrame, data_source: DataFrame, qualifying: DataFrame, min_year: int, max_year: int
) -> DataFrame:
    """Set ``include_in_analysis`` on every row: the series qualifies and the year is within its source's bounds.

    A row without series id has an unknown answer (NULL) unless its year is out.  Rows
    are never multiplied: where a source has several rows for a taxon, their widest
    bounds hold, an open one above all.
    """
    open_start, open_end = (F.bool_or(F.col(y).isNull()) for y in ("start_year", "end_year"))
    bounds = data_source.groupBy("taxon_id", "source_id").agg(
        F.when(~open_start, F.min("start_year")).alias("start_year"), F.when(~open_end, F.max("end_year")).alias("end_year")
    )
    chosen = qualifying.select("time_series_id").distinct().withColumn("_chosen", F.lit(True))
    member = F.when(F.col("time_series_id").isNotNull(), F.col("_chosen").isNotNull())
    return (
        agg.drop("include_in_analysis")
        .join(chosen, "time_series_id", "left")
        .join(bounds, ["taxon_id", "source_id"], "left")
        .withColumn("include_in_analysis", member & _within_source_years(min_year, max_year))
        .drop("_chosen", "start_year", "end_year")
    )
