"""Which processing method fits each taxon x unit x source x search type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldloom.constants import (
    CLASSIFIED_UNIT_TYPE,
    COUNT_SOURCES,
    COUNT_VARIABLE,
    OTHER_VARIABLE,
    REPORTING_RATE,
    SITE_DESIGN,
)

# column -> (type, default); the layout of a profile table
PROFILE_COLUMNS: dict[str, tuple[str, object]] = {
    "taxon_id": ("string", None),
    "unit_id": ("int", None),
    "unit_type_id": ("int", None),
    "source_id": ("int", None),
    "search_type_id": ("int", None),
    "survey_id_count": ("bigint", None),
    "site_id_count": ("bigint", None),
    "data_type": ("int", None),
    "experimental_design_type_id": ("int", SITE_DESIGN),
    "response_variable_type_id": ("int", 0),
    "response_variable_type_id_previous": ("int", 0),
    "matches_previous": ("boolean", False),
    "is_orphan": ("boolean", False),
    "n_count_values": ("bigint", None),
    "min_count": ("double", None),
    "n_months": ("bigint", None),
    "n_years": ("bigint", None),
    "max_count": ("double", None),
    "positional_accuracy_threshold_in_m": ("double", None),
    "max_status_id": ("int", None),
    "taxon_defunct": ("boolean", False),
}
METHOD_KEYS = ["taxon_id", "unit_id", "source_id", "search_type_id"]

#: Tasks that sightings and their surveys are dealt to, and their combinations after that.  Each holds
#: the distinct values of its share, four a row, so few tasks would mean much memory in each.
SPREAD = 200
#: Places that the rows of a combination are dealt to.
SALTS = 16


def _with_surveys(sightings: DataFrame, surveys: DataFrame) -> DataFrame:
    """Sightings with their survey, over a fixed number of tasks: the rows multiply after this join."""
    return sightings.repartition(SPREAD, "survey_id").join(surveys.repartition(SPREAD, "survey_id"), "survey_id")


def _profile(rows: DataFrame, taxon: DataFrame, data_type: int) -> DataFrame:
    """Counts and extremes per combination.

    Rows come dealt by survey, so the first one of each survey and combination is marked
    where it is, and surveys are counted by their marks.  Each row is then shuffled once, as it
    is, to one of SALTS places of its combination, by its site.  There every row tells its
    site, month, year and count as tagged values, made distinct per combination: sites meet
    nowhere else, and of the others, which repeat, one row for each value goes on.  So the raw join is read
    once, and a combination with a third of all rows spreads over several tasks.  An unknown month
    counts as month 0 of its year, an unknown year or count not at all.
    """
    combination = ["taxon_id", "unit_id", "unit_type_id", "source_id", "search_type_id"]
    of_survey = W.partitionBy(*combination, "survey_id").orderBy("survey_id")
    dealt = (
        rows.withColumn("new_survey", (F.row_number().over(of_survey) == 1) & F.col("survey_id").isNotNull())
        .select(*combination, "new_survey", "site_id", "start_date_y", "start_date_m", "count", F.pmod(F.xxhash64("site_id"), F.lit(SALTS)).alias("salt"))
        .repartition(SPREAD, *combination, "salt")
    )
    ids = {
        "site_id_count": F.col("site_id"),
        "n_months": F.col("start_date_y") * 100 + F.coalesce(F.col("start_date_m"), F.lit(0)),
        "n_years": F.col("start_date_y"),
    }
    unknown = F.lit(None).cast(rows.schema["count"].dataType)
    told = [F.struct(F.lit(name).alias("tag"), value.cast("long").alias("id"), unknown.alias("count"), (F.col("new_survey") & F.lit(name == "n_years")).cast("long").alias("surveys"))
            for name, value in ids.items()]
    told.append(F.struct(F.lit("count").alias("tag"), F.lit(None).cast("long").alias("id"), F.col("count"), F.lit(0).cast("long").alias("surveys")))
    by_tag = [*combination, "salt", "tag", "id", "count"]
    here = dealt.select(*combination, "salt", F.inline(F.array(*told))).groupBy(*by_tag).agg(F.sum("surveys").alias("surveys"))
    is_site = F.col("tag") == "site_id_count"
    values = here.groupBy(*combination, "tag", F.when(~is_site, F.col("id")).alias("id"), "count").agg(
        F.sum("surveys").alias("surveys"), F.count(F.when(is_site, F.col("id"))).alias("sites")
    )
    statuses = taxon.select(F.col("id").alias("taxon_id"), "max_status_id")
    return (
        values.groupBy(*combination)
        .agg(
            F.sum("surveys").alias("survey_id_count"), F.sum("sites").alias("site_id_count"),
            F.count("count").alias("n_count_values"), F.min("count").alias("min_count"), F.max("count").alias("max_count"),
            *[F.count(F.when(F.col("tag") == name, F.col("id"))).alias(name) for name in ("n_months", "n_years")],
        )
        .join(statuses, "taxon_id")
        .withColumn("data_type", F.lit(data_type))
    )


def method_profile_direct(
    source: DataFrame, survey: DataFrame, sighting: DataFrame, site: DataFrame, taxon: DataFrame
) -> DataFrame:
    """Profile of type-1 data: sightings name their taxon, the site gives the search type."""
    known = survey.join(source.select(F.col("id").alias("source_id")), "source_id", "left_semi")
    surveys = known.select(
        F.col("id").alias("survey_id"), "source_id", "site_id", "start_date_y", "start_date_m"
    ).join(site.select(F.col("id").alias("site_id"), "search_type_id"), "site_id")
    sightings = sighting.select("survey_id", "taxon_id", "unit_id", "unit_type_id", "count")
    return _profile(_with_surveys(sightings, surveys), taxon, 1)


def method_profile_linked(
    source: DataFrame, survey: DataFrame, sighting: DataFrame, taxon_sighting: DataFrame, taxon: DataFrame
) -> DataFrame:
    """Profile of type-2 data: a link table gives the taxa of a sighting, the survey its search type and site."""
    known = survey.join(source.select(F.col("id").alias("source_id")), "source_id", "left_semi")
    surveys = known.select(
        F.col("id").alias("survey_id"), "source_id", "search_type_id", "site_id", "start_date_y", "start_date_m"
    )
    sightings = sighting.select(F.col("id").alias("sighting_id"), "survey_id", "unit_id", "unit_type_id", "count").join(
        taxon_sighting.select("sighting_id", "taxon_id"), "sighting_id"
    )
    return _profile(_with_surveys(sightings, surveys), taxon, 2)


def append_profiles(*profiles: DataFrame) -> DataFrame:
    """All profiles in one table; a column a profile lacks gets the layout's default."""

    def fitted(profile: DataFrame) -> DataFrame:
        columns: list[Column] = []
        for name, (kind, default) in PROFILE_COLUMNS.items():
            value = F.col(name) if name in profile.columns else F.lit(default)
            columns.append(value.cast(kind).alias(name))
        return profile.select(*columns)

    table = fitted(profiles[0])
    for profile in profiles[1:]:
        table = table.unionByName(fitted(profile))
    return table


def classify_response_variable(profiles: DataFrame, count_sources: Iterable[int] = COUNT_SOURCES) -> DataFrame:
    """Set the response variable: counts for the listed sources, reporting rate for its unit type, else the other."""
    variable = (
        F.when(F.col("source_id").isin(*count_sources), COUNT_VARIABLE)
        .when(F.col("unit_type_id") == CLASSIFIED_UNIT_TYPE, REPORTING_RATE)
        .otherwise(OTHER_VARIABLE)
    )
    return profiles.withColumn("response_variable_type_id", variable)


def _same_method(left: DataFrame, right: DataFrame, null_safe: bool) -> list[Column]:
    if null_safe:
        return [left[k].eqNullSafe(right[f"_{k}"]) for k in METHOD_KEYS]
    return [left[k] == right[f"_{k}"] for k in METHOD_KEYS]


def orphan_methods(previous: DataFrame, current: DataFrame, taxon: DataFrame, null_safe: bool = False) -> DataFrame:
    """Previous combinations that the current profiles no longer hold.

    ``taxon_defunct`` tells the taxa that have left the taxonomy.  A combination
    with a NULL part matches nothing and is always an orphan, unless ``null_safe``.
    """
    held = current.select(*[F.col(k).alias(f"_{k}") for k in METHOD_KEYS]).distinct()
    statuses = taxon.select(F.col("id").alias("taxon_id"), "max_status_id", F.lit(False).alias("gone"))
    return (
        previous.join(held, _same_method(previous, held, null_safe), "left_anti")
        .join(statuses, "taxon_id", "left")
        .select(
            *METHOD_KEYS, "data_type", "experimental_design_type_id",
            F.col("response_variable_type_id").alias("response_variable_type_id_previous"),
            F.lit(True).alias("is_orphan"), "max_status_id",
            F.coalesce("gone", F.lit(True)).alias("taxon_defunct"),
        )
    )


def attach_previous_method(current: DataFrame, previous: DataFrame, null_safe: bool = False) -> DataFrame:
    """Set the previous response variable and whether it is still the same.

    Where the previous table repeats a combination, the lowest variable is taken.
    Rows without a previous method keep what they have.
    """
    old = (
        previous.groupBy(*[F.col(k).alias(f"_{k}") for k in METHOD_KEYS])
        .agg(F.min("response_variable_type_id").alias("_previous"))
    )
    had = F.col("_previous").isNotNull()
    same = F.col("response_variable_type_id") == F.col("_previous")
    changed = {
        "response_variable_type_id_previous": F.coalesce("_previous", "response_variable_type_id_previous"),
        "matches_previous": F.when(had, same).otherwise(F.col("matches_previous")),
    }
    return current.join(old, _same_method(current, old, null_safe), "left").select(
        *[changed.get(c, current[c]).alias(c) for c in current.columns]
    )


def method_report(
    profiles: DataFrame,
    taxon: DataFrame,
    search_type: DataFrame,
    unit: DataFrame,
    unit_type: DataFrame,
    source: DataFrame,
    taxon_status: DataFrame,
) -> DataFrame:
    """The profiles with series and data ids and the descriptions of their codes.

    ``ts_id`` needs all its parts, so combinations without unit type or search
    type have none.
    """

    def described(lookup: DataFrame, key: str, label: str) -> DataFrame:
        return lookup.select(F.col("id").alias(key), F.col("description").alias(label))

    taxa = taxon.select(F.col("id").alias("taxon_id"), "taxonomic_group", "common_name", "scientific_name")

    def joined(*parts: str) -> Column:
        with_bars = [F.col(parts[0])] + [x for p in parts[1:] for x in (F.lit("_"), F.col(p))]
        return F.concat(*[c.cast("string") for c in with_bars])

    return (
        profiles.join(taxa, "taxon_id", "left")
        .join(described(search_type, "search_type_id", "search_type_description"), "search_type_id", "left")
        .join(described(unit, "unit_id", "unit_description"), "unit_id", "left")
        .join(described(unit_type, "unit_type_id", "unit_type_description"), "unit_type_id", "left")
        .join(described(source, "source_id", "source_description"), "source_id", "left")
        .join(described(taxon_status, "max_status_id", "max_taxon_status"), "max_status_id", "left")
        .select(
            joined("source_id", "taxon_id", "search_type_id", "unit_type_id", "unit_id").alias("ts_id"),
            joined("source_id", "taxon_id").alias("data_id"),
            "taxon_defunct", "taxonomic_group", "taxon_id", "common_name", "scientific_name", "max_taxon_status",
            "unit_type_id", "unit_type_description", "unit_id", "unit_description", "source_id",
            "source_description", "search_type_id", "search_type_description", "data_type",
            "experimental_design_type_id", "response_variable_type_id", "response_variable_type_id_previous",
            "matches_previous", "is_orphan", "survey_id_count", "site_id_count", "n_count_values", "min_count",
            "max_count", "n_months", "n_years", "positional_accuracy_threshold_in_m",
        )
    )
