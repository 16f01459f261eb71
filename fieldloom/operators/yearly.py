"""Yearly series per site and taxon, and their flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.constants import CLASSIFIED_UNIT_TYPE, REPORTING_RATE
from fieldloom.functions.rates import ratio
from fieldloom.operators import monthly

SERIES_KEYS = ["taxon_id", "site_id", "survey_type_id"]


def data_by_year(data_by_month: DataFrame) -> DataFrame:
    """Yearly sums and unweighted means of the monthly values.

    A month without surveys is absent, not 0, and does not weigh on the means.
    """
    return data_by_month.groupBy(
        "site_id", "survey_type_id", "site_permutation", "year", "taxon_id", "range_id"
    ).agg(
        F.sum("num_surveys").alias("num_surveys"),
        F.sum("num_sightings").alias("num_sightings"),
        F.avg("rr").alias("mean_monthly_rr"),
        F.avg("mean_of_count").alias("monthly_mean_of_mean_of_count"),
        F.avg("mean_abundance").alias("monthly_mean_abundance"),
        F.sum("abundance_surveys").alias("abundance_surveys"),
    )


def data_by_year_from_counts(surveys_per_site: DataFrame, sightings_per_site: DataFrame, sites_in_ranges: DataFrame,
                             sites: DataFrame, strict: bool = False) -> DataFrame:
    """The same table straight from the monthly counts per site and per species.

    All taxa and ranges of a species share its monthly values at a site, and a
    surveyed month without sightings adds 0 to each sum.  So the months are summed
    per site and per species, and only whole years meet the taxa: the monthly table
    per taxon, by far the largest of all, is never made.  ``strict`` and
    ``abundance_surveys`` are those of ``monthly.data_by_month``, the latter summed: a
    year with as few of them as 0 rests on sightings without a count.
    """
    site = ["site_id", "site_type"]
    years = surveys_per_site.groupBy(*site, "year").agg(
        F.sum("num_surveys").alias("num_surveys"), F.count("*").alias("months")
    )
    sums = {
        "mean_monthly_rr": ratio(F.col("num_sightings"), F.col("num_surveys")),
        "monthly_mean_of_mean_of_count": monthly.mean_of_count(),
        "monthly_mean_abundance": monthly.mean_abundance(strict),
    }
    seen = (
        sightings_per_site.join(surveys_per_site, [*site, "year", "month"])
        .groupBy(*site, "year", "sp_id")
        .agg(
            F.sum("num_sightings").alias("num_sightings"), F.sum("num_po_sightings").alias("num_po_sightings"),
            *[F.sum(v).alias(name) for name, v in sums.items()],
        )
    )
    attributes = sites.select("site_id", F.col("site_type").alias("survey_type_id"), "site_permutation")
    return (
        years.join(sites_in_ranges, site)
        .join(seen, [*site, "year", "sp_id"], "left")
        .join(attributes, "site_id")
        .select(
            "site_id", "survey_type_id", "site_permutation", "year", "taxon_id", "range_id", "num_surveys",
            F.coalesce("num_sightings", F.lit(0)).alias("num_sightings"),
            *[(F.coalesce(name, F.lit(0.0)) / F.col("months")).alias(name) for name in sums],
            (F.col("num_surveys") - F.coalesce("num_po_sightings", F.lit(0))).alias("abundance_surveys"),
        )
    )


def assign_response_variable(
    series: DataFrame,
    processing_method: DataFrame,
    response_variable: int = REPORTING_RATE,
    unit_type: int = CLASSIFIED_UNIT_TYPE,
) -> DataFrame:
    """Set ``response_variable_type_id`` where the taxon and survey type have such a method, else NULL."""
    methods = (
        processing_method.where(
            (F.col("response_variable_type_id") == response_variable) & (F.col("unit_type_id") == unit_type)
        )
        .select("taxon_id", F.col("search_type_id").alias("survey_type_id"))
        .distinct()
        .withColumn("response_variable_type_id", F.lit(response_variable).cast("short"))
    )
    return series.drop("response_variable_type_id").join(methods, ["taxon_id", "survey_type_id"], "left")


def flag_all_zero(series: DataFrame, value: str, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """``all0_values`` = 1 on every row of a series whose values sum to 0, else NULL.

    Range classes of a series count together.  The zero series are found by
    aggregation and joined back, so rows with a NULL key stay unflagged and do not
    gather in one task.
    """
    zero = (
        series.groupBy(*keys)
        .agg(F.sum(value).alias("total"))
        .where(F.col("total") == 0)
        .select(*keys, F.lit(1).cast("short").alias("all0_values"))
    )
    return series.drop("all0_values").join(zero, list(keys), "left")


def site_count_summary(series: DataFrame, taxonomy: DataFrame, survey_type: DataFrame) -> DataFrame:
    """Distinct sites per taxon, response variable and survey type, where the variable is set."""
    return (
        series.where(F.col("response_variable_type_id").isNotNull())
        .groupBy("taxon_id", "response_variable_type_id", "survey_type_id")
        .agg(F.countDistinct("site_id").alias("num_sites"))
        .join(taxonomy.select("taxon_id", "taxon_name"), "taxon_id")
        .join(survey_type.select(F.col("id").alias("survey_type_id"), "name"), "survey_type_id")
        .select("taxon_id", "taxon_name", "response_variable_type_id", "survey_type_id", "name", "num_sites")
    )
