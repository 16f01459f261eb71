"""Comparison of the current edition of the yearly series with the prior one.

The current edition is a ``data_by_year`` table; the prior one has its own older
layout (``start_date_y, site_id, search_type_id, taxon_id,
response_variable_type_id, value, source_id, unit_id, lat, lon, survey_count``)
and gets ``site_id_current``, the site of the current edition at its place.
Values are compared at four decimals, the precision of the prior edition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.constants import (
    CUT_YEAR,
    EDITION_WIDE_YEARS,
    MAIN_RANGE,
    MEAN_YEARS_BEFORE,
    ORIGINAL_PERMUTATION,
    POINT_SRID,
    PRIOR_SOURCE,
    PRIOR_YEAR_AFTER,
    REPORTING_RATE,
    SURVEY_TYPES,
    VALUE_DECIMALS,
)
from fieldloom.functions.rates import exact_mean, exact_sum, mean_where, share_of_years
from fieldloom.operators import geo

# the two survey types by the size of their plots, as column name parts
PLOT_NAMES = dict(zip(SURVEY_TYPES, ("2ha", "500m")))

PRIOR_COLUMNS = {
    "start_date_y": "short", "site_id": "bigint", "search_type_id": "int", "taxon_id": "string",
    "response_variable_type_id": "int", "value": "decimal(7,4)", "source_id": "int", "unit_id": "int",
    "lat": "double", "lon": "double", "survey_count": "bigint",
}


def load_prior_edition(raw: DataFrame, source_id: int = PRIOR_SOURCE) -> DataFrame:
    """One source of the prior edition, typed, with values at four decimals.

    A centroid given as columns ``centroid_x, centroid_y`` is split into lon and
    lat.  Blanks that pad a fixed-width taxon id are cut.
    """
    named = raw
    if "centroid_x" in raw.columns:
        named = raw.withColumn("lon", F.col("centroid_x")).withColumn("lat", F.col("centroid_y"))
    typed = {name: F.col(name).cast(kind) for name, kind in PRIOR_COLUMNS.items()}
    typed["value"] = F.round("value", VALUE_DECIMALS).cast(PRIOR_COLUMNS["value"]).cast("double")
    typed["taxon_id"] = F.rtrim(F.col("taxon_id").cast("string"))
    return named.where(F.col("source_id") == source_id).select(*[typed[n].alias(n) for n in PRIOR_COLUMNS])


def point_from_lonlat(df: DataFrame, lon: str = "lon", lat: str = "lat", srid: int = POINT_SRID) -> DataFrame:
    """Add the point: x = longitude, y = latitude, and ``srid``, which x and y tell as metadata too.

    Joins refuse to bring such points together with outlines that tell another system.
    """
    points = df.withColumn("x", F.col(lon).cast("double")).withColumn("y", F.col(lat).cast("double"))
    return geo.with_srid(points, srid).withColumn("srid", F.lit(srid))


def back_attribute_sites(prior: DataFrame, sites: DataFrame, site_vertex: geo.Layer) -> DataFrame:
    """Add ``site_id_current``: the current site of the same type that covers the prior site's point.

    The match uses place and type, the attribution goes by prior site id, and where
    several sites match, the lowest id is taken.
    """
    places = (
        point_from_lonlat(prior).select(F.col("site_id").alias("prior_site_id"), "search_type_id", "x", "y")
        .where(F.col("prior_site_id").isNotNull())
        .distinct()
    )
    covering = geo.points_in_polygons(places, site_vertex, ["site_id"])
    types = sites.select("site_id", F.col("site_type").alias("search_type_id"))
    matched = (
        covering.join(types, ["site_id", "search_type_id"])
        .groupBy(F.col("prior_site_id").alias("site_id"))
        .agg(F.min("site_id").alias("site_id_current"))
    )
    return prior.drop("site_id_current").join(matched, "site_id", "left")


# --- summaries per taxon -----------------------------------------------------------


def _summary(rows: DataFrame, survey_type: str, value: str, sums: dict[str, str], suffix: str) -> DataFrame:
    """Per taxon and survey type: distinct sites, sums and mean value, spread into columns.

    Sites are reduced to one row first, so distinct sites are a plain count.
    """
    per_site = rows.groupBy("taxon_id", survey_type, "site_id").agg(
        *[F.sum(c).alias(c) for c in sums],
        exact_sum(F.col(value)).alias("value_sum"),
        F.count(value).alias("value_count"),
    )
    spread: list[Column] = []
    for code, plot in PLOT_NAMES.items():
        of_type = F.col(survey_type) == code
        spread.append(F.count(F.when(of_type, F.col("site_id"))).alias(f"num_{plot}_sites{suffix}"))
        for column, label in sums.items():
            spread.append(F.sum(F.when(of_type, F.col(column))).alias(f"{label}_{plot}_sites{suffix}"))
        total = exact_sum(F.when(of_type, F.col("value_sum")))
        mean = F.try_divide(total, F.sum(F.when(of_type, F.col("value_count")))).cast("double")
        spread.append(F.round(mean, VALUE_DECIMALS).alias(f"mean_monthly_rr_{plot}_sites{suffix}"))
    return per_site.groupBy("taxon_id").agg(*spread)


def _named(summary: DataFrame, taxonomy: DataFrame) -> DataFrame:
    rest = [c for c in summary.columns if c != "taxon_id"]
    return summary.join(taxonomy.select("taxon_id", "taxon_name"), "taxon_id", "left").select(
        "taxon_id", "taxon_name", *rest
    )


def prior_edition_summary(prior: DataFrame, taxonomy: DataFrame, suffix: str = "_prior") -> DataFrame:
    """Sites, surveys and mean rate per taxon, for either plot size, in the prior edition."""
    rows = prior.where(F.col("response_variable_type_id") == REPORTING_RATE)
    return _named(_summary(rows, "search_type_id", "value", {"survey_count": "num_surveys"}, suffix), taxonomy)


def current_edition_summary(
    series: DataFrame, taxonomy: DataFrame, before: int = CUT_YEAR, suffix: str = "_current"
) -> DataFrame:
    """The same for the current edition: variable set, years before the cut, main range, original sites."""
    rows = series.where(
        F.col("response_variable_type_id").isNotNull()
        & (F.col("year") < before)
        & (F.col("range_id") == MAIN_RANGE)
        & (F.col("site_permutation") == ORIGINAL_PERMUTATION)
    )
    sums = {"num_surveys": "num_surveys", "num_sightings": "num_sightings"}
    return _named(_summary(rows, "survey_type_id", "mean_monthly_rr", sums, suffix), taxonomy)


def distinct_sighting_sums(series: DataFrame, sightings: str = "num_sightings", survey_type: str = "survey_type_id") -> DataFrame:
    """Per taxon, the sum of the distinct numbers of sightings at sites of either type; NULL without any.

    Numbers are made distinct per taxon and type first, so the sums are plain ones, and a
    taxon with most rows is spread by its numbers.
    """
    numbers = series.select("taxon_id", survey_type, sightings).where(F.col(sightings).isNotNull()).distinct()
    sums = [
        F.sum(F.when(F.col(survey_type) == code, F.col(sightings))).alias(f"num_sightings_{plot}_sites") for code, plot in PLOT_NAMES.items()
    ]
    taxa = series.select("taxon_id").distinct()
    return taxa.join(numbers.groupBy("taxon_id").agg(*sums), "taxon_id", "left")


def compare_edition_summaries(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Both summaries side by side for every taxon of the current edition."""
    pairs = [
        f"{stem}_{plot}_sites_{edition}"
        for plot in PLOT_NAMES.values()
        for stem in ("num", "num_surveys", "mean_monthly_rr")
        for edition in ("prior", "current")
    ]
    return current.join(prior.drop("taxon_name"), "taxon_id", "left").select("taxon_id", "taxon_name", *pairs)


# --- value by value ----------------------------------------------------------------

_PAIR_KEYS = ["site_id", "survey_type_id", "year", "taxon_id"]


def _prior_by_current_keys(prior: DataFrame) -> DataFrame:
    return prior.withColumnsRenamed({"site_id": "site_id_prior"}).withColumnsRenamed(
        {"site_id_current": "site_id", "search_type_id": "survey_type_id", "start_date_y": "year"}
    )


def flag_value_differs(series: DataFrame, prior: DataFrame, prior_after: int = PRIOR_YEAR_AFTER) -> DataFrame:
    """Add ``value_differs``: does the rate differ from the prior edition's for this site, type, year and taxon?

    False if any prior value equals it, else true if any differs, NULL without a
    counterpart.  Only the main range is compared, only years before the prior
    edition's last; the answer then holds for every range and permutation of the key.
    """
    last_year = prior.agg(F.max("start_date_y")).scalar()
    old = _prior_by_current_keys(
        prior.where(
            (F.col("response_variable_type_id") == REPORTING_RATE)
            & (F.col("start_date_y") > prior_after)
            & (F.col("start_date_y") < last_year)
        )
    ).select(*_PAIR_KEYS, F.round("value", VALUE_DECIMALS).alias("old"))
    new = series.where(F.col("range_id") == MAIN_RANGE).select(
        *_PAIR_KEYS, F.round("mean_monthly_rr", VALUE_DECIMALS).alias("new")
    )
    verdict = (
        new.join(old, _PAIR_KEYS)
        .where(F.col("new").isNotNull() & F.col("old").isNotNull())
        .groupBy(*_PAIR_KEYS)
        .agg(F.min(F.col("new") != F.col("old")).alias("value_differs"))
    )
    return series.drop("value_differs").join(verdict, _PAIR_KEYS, "left")


def value_difference_counts(
    flagged: DataFrame, taxonomy: DataFrame, survey_type: DataFrame, before: int = CUT_YEAR
) -> DataFrame:
    """Rows per taxon and survey type that differ, match or lack a counterpart, all-zero series apart."""
    rows = flagged.where(
        (F.col("site_permutation") == ORIGINAL_PERMUTATION)
        & (F.col("response_variable_type_id") == REPORTING_RATE)
        & (F.col("year") < before)
    )
    answers = {
        "differ": F.col("value_differs"),
        "match": ~F.col("value_differs"),
        "match_null": F.col("value_differs").isNull(),
    }
    groups = {"qualifying": F.col("all0_values").isNull(), "all0": F.col("all0_values") == 1}
    counts = [
        F.count(F.when(answer & group, F.col("site_id"))).alias(f"num_{g}_ts_{a}")
        for a, answer in answers.items()
        for g, group in groups.items()
    ]
    names = [f"num_{g}_ts_{a}" for a in answers for g in groups]
    return (
        rows.groupBy("taxon_id", "survey_type_id")
        .agg(*counts)
        .join(survey_type.select(F.col("id").alias("survey_type_id"), "name"), "survey_type_id")
        .join(taxonomy.select("taxon_id", "taxon_name"), "taxon_id", "left")
        .select("taxon_id", "taxon_name", "name", *names)
    )


# --- series by series --------------------------------------------------------------


def _series_measures(year: str, value: str, sums: dict[str, str]) -> list[Column]:
    first, last, sampled = F.min(year), F.max(year), F.count(year)
    length = last - first + 1
    return [
        *[F.sum(column).alias(label) for column, label in sums.items()],
        F.count(F.when(F.col(value) == 0, F.col(year))).alias("num_0s"),
        exact_mean(F.col(value)).alias("mean_rr"),
        first.cast("int").alias("ts_start_year"),
        last.cast("int").alias("ts_end_year"),
        sampled.alias("ts_sample_years"),
        length.cast("int").alias("ts_length"),
        # whole multiples only: 100 for a series without a gap, 0 for any other
        (F.floor(sampled / length) * 100).alias("ts_completeness"),
        share_of_years(first, last, sampled).alias("ts_completeness_exact"),
    ]


def _series_summary(rows: DataFrame, type_column: str, sites: DataFrame, survey_type: DataFrame, join_on: str,
                    measures: list[Column]) -> DataFrame:
    """Per taxon, site, permutation and type; names and permutation are looked up after grouping."""
    originals = sites.where(F.col("site_permutation") == ORIGINAL_PERMUTATION).select(
        F.col("site_id").alias(join_on), "site_permutation"
    )
    keys = list(dict.fromkeys(["taxon_id", "site_id", type_column]))
    kept = rows.join(originals, join_on)
    grouped = kept.groupBy(*keys, "site_permutation").agg(*measures)
    types = survey_type.select(F.col("id").alias(type_column), "name")
    rest = [c for c in grouped.columns if c not in (*keys, "site_permutation")]
    return grouped.join(types, type_column).select("taxon_id", "site_id", "site_permutation", "name", *rest)


def current_series_summary(
    series: DataFrame, sites: DataFrame, survey_type: DataFrame, before: int = CUT_YEAR
) -> DataFrame:
    """Length, gaps, zeros and mean of every current series on an original site, years before the cut."""
    rows = series.where(
        (F.col("response_variable_type_id") == REPORTING_RATE)
        & (F.col("year") < before)
        & (F.col("range_id") == MAIN_RANGE)
    ).drop("site_permutation")
    sums = {"num_surveys": "ts_surveys", "num_sightings": "num_sightings"}
    measures = _series_measures("year", "mean_monthly_rr", sums)
    return _series_summary(rows, "survey_type_id", sites, survey_type, "site_id", measures)


def prior_series_summary(
    prior: DataFrame, sites: DataFrame, survey_type: DataFrame, before: int = CUT_YEAR, by_prior_site: bool = False
) -> DataFrame:
    """The same for the prior edition, by the current site it was attributed to.

    ``by_prior_site=True`` looks the permutation up under the prior site id instead.
    Several prior sites or units may share a key, and completeness then exceeds 100.
    """
    rows = prior.where(
        (F.col("response_variable_type_id") == REPORTING_RATE) & (F.col("start_date_y") < before)
    ).withColumnsRenamed({"site_id": "site_id_prior"}).withColumnsRenamed({"site_id_current": "site_id"})
    measures = _series_measures("start_date_y", "value", {"survey_count": "ts_surveys"})
    join_on = "site_id_prior" if by_prior_site else "site_id"
    return _series_summary(rows, "search_type_id", sites, survey_type, join_on, measures)


def non_matching_series(current: DataFrame, prior: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Per taxon: series, and how many of them have another mean rate than in the prior edition."""
    total = current.groupBy("taxon_id").agg(F.countDistinct("site_id").alias("total_ts"))
    old = prior.select("taxon_id", "site_id", F.round("mean_rr", VALUE_DECIMALS).alias("old"))
    unequal = (
        current.select("taxon_id", "site_id", F.round("mean_rr", VALUE_DECIMALS).alias("new"))
        .join(old, ["taxon_id", "site_id"])
        .where(F.col("new") != F.col("old"))
        .groupBy("taxon_id")
        .agg(F.count("*").alias("found"))
    )
    number = F.coalesce("found", F.lit(0))
    return (
        total.join(unequal, "taxon_id", "left")
        .join(taxonomy.select("taxon_id", "taxon_name"), "taxon_id")
        .select(
            "taxon_id", "taxon_name", "total_ts", number.alias("num_unequal_ts"),
            F.round(100.0 * number / F.col("total_ts"), 2).alias("percentage_unequal_ts"),
        )
    )


def qualifying_series_statistics(
    current: DataFrame, prior: DataFrame, non_matching: DataFrame, taxonomy: DataFrame
) -> DataFrame:
    """Per taxon, over current series with sightings: counts and means of both editions side by side."""
    places = {"mean_rr": (4, "mean_rr"), "ts_start_year": (0, "mean_ts_start_year"),
              "ts_sample_years": (2, "mean_ts_sample_years"), "ts_length": (2, "mean_ts_length")}
    old = prior.select("taxon_id", "site_id", F.lit(1).alias("paired"), *[F.col(c).alias(f"old_{c}") for c in places])
    means = [
        F.round(exact_mean(F.col(prefix + column)), digits).alias(f"{label}_{edition}")
        for column, (digits, label) in places.items()
        for prefix, edition in (("old_", "prior"), ("", "current"))
    ]
    statistics = (
        current.where(F.col("num_sightings") > 0)
        .join(old, ["taxon_id", "site_id"], "left")
        .groupBy("taxon_id")
        .agg(
            F.count("paired").alias("num_qualifying_ts_prior"),
            F.count("site_id").alias("num_qualifying_ts_current"),
            *means,
        )
    )
    totals = non_matching.select("taxon_id", "total_ts", "num_unequal_ts", "percentage_unequal_ts")
    rest = [c for c in statistics.columns if c != "taxon_id"]
    return (
        statistics.join(totals, "taxon_id")
        .join(taxonomy.select("taxon_id", "taxon_name"), "taxon_id")
        .select("taxon_id", "taxon_name", "total_ts", "num_unequal_ts", "percentage_unequal_ts", *rest)
    )


def rate_and_abundance_length(series: DataFrame) -> DataFrame:
    """Years from the first to the last value above 0, for reporting rate and for mean abundance, per series.

    Completes a planned comparison that was only noted; a variable without a value
    above 0 has no length.
    """

    def length(value: str) -> Column:
        year = F.when(F.col(value) > 0, F.col("year"))
        return (F.max(year) - F.min(year) + 1).cast("int")

    return series.groupBy("taxon_id", "site_id", "survey_type_id").agg(
        length("mean_monthly_rr").alias("rr_length"), length("monthly_mean_abundance").alias("abundance_length")
    )


# --- paired rows -------------------------------------------------------------------


def edition_pairs(series: DataFrame, prior: DataFrame, prior_after: int = PRIOR_YEAR_AFTER) -> DataFrame:
    """Current and prior values of the same site, type, year and taxon, one row per pair."""
    old = _prior_by_current_keys(prior.where(F.col("start_date_y") > prior_after)).select(
        *_PAIR_KEYS,
        F.col("unit_id").alias("prior_unit"),
        F.col("response_variable_type_id").alias("prior_response_variable"),
        F.col("source_id").alias("prior_source"),
        F.col("survey_count").alias("prior_num_surveys"),
        F.col("value").alias("prior_value"),
    )
    return (
        series.select(
            *_PAIR_KEYS, "site_permutation", "num_surveys", "num_sightings", F.col("mean_monthly_rr").alias("value")
        )
        .join(old, _PAIR_KEYS)
        .select(
            "taxon_id", "site_id", "site_permutation", F.col("survey_type_id").alias("search_type_id"), "year",
            "prior_unit", "prior_response_variable", "prior_source", "prior_num_surveys", "num_surveys",
            "num_sightings", "prior_value", "value",
        )
    )


def with_rate_delta(pairs: DataFrame) -> DataFrame:
    """Add ``rr_delta``; positive is more in the current edition."""
    return pairs.withColumn("rr_delta", F.col("value") - F.col("prior_value"))


def aggregated_deltas(
    pairs: DataFrame, by: Sequence[str] = ("taxon_id", "site_permutation", "search_type_id", "year")
) -> DataFrame:
    """Sites, surveys, sightings and mean rates of paired rows, with differences towards the current edition.

    Completes an unfinished aggregate from its notes.  ``sites_more`` and
    ``sites_less`` count the sites whose summed rate went up or down.
    """
    per_site = pairs.groupBy(*by, "site_id").agg(
        F.sum("num_surveys").alias("n"), F.sum("prior_num_surveys").alias("pn"),
        F.sum("num_sightings").alias("s"),
        exact_sum(F.col("value")).alias("v"), exact_sum(F.col("prior_value")).alias("pv"), F.count("*").alias("rows"),
    ).withColumn("d", F.round(F.col("v") - F.col("pv"), VALUE_DECIMALS))
    new, old, rows = exact_sum(F.col("v")), exact_sum(F.col("pv")), F.sum("rows")
    return per_site.groupBy(*by).agg(
        F.count("site_id").alias("sites"),
        F.count(F.when(F.col("d") > 0, 1)).alias("sites_more"),
        F.count(F.when(F.col("d") < 0, 1)).alias("sites_less"),
        F.sum("n").alias("surveys"),
        F.sum("pn").alias("prior_surveys"),
        (F.sum("n") - F.sum("pn")).alias("surveys_delta"),
        F.sum("s").alias("sightings"),
        (new / rows).cast("double").alias("mean_rr"),
        (old / rows).cast("double").alias("prior_mean_rr"),
        ((new - old) / rows).cast("double").alias("mean_rr_delta"),
    )


def mean_yearly_rate(
    pairs: DataFrame, before: int = MEAN_YEARS_BEFORE, permutation: str = ORIGINAL_PERMUTATION
) -> DataFrame:
    """Mean value of both editions per year, in order of year."""
    return (
        pairs.where((F.col("year") < before) & (F.col("site_permutation") == permutation))
        .groupBy("year")
        .agg(
            exact_mean(F.col("prior_value")).alias("mean_prior_value"),
            exact_mean(F.col("value")).alias("mean_current_value"),
        )
        .orderBy(F.asc_nulls_last("year"))
    )


def rate_by_factor(pairs: DataFrame, factors: Sequence[str], cube: bool = False) -> DataFrame:
    """Mean rates and their difference by chosen factors (search type, source, year, region ...).

    ``cube=True`` adds the totals over every subset of the factors.
    """
    grouped = pairs.cube(*factors) if cube else pairs.groupBy(*factors)
    return grouped.agg(
        F.count("*").alias("n"),
        exact_mean(F.col("prior_value")).alias("prior_mean_rr"),
        exact_mean(F.col("value")).alias("mean_rr"),
        exact_mean(F.col("value") - F.col("prior_value")).alias("mean_rr_delta"),
    )


def unmatched_sites(series: DataFrame, prior: DataFrame) -> DataFrame:
    """Sites that only one edition has: edition, site_id (the current id; a prior site without one keeps its own)."""
    new = series.select("site_id").distinct()
    old = prior.select("site_id_current", "site_id").distinct()
    only_new = new.join(
        old.select(F.col("site_id_current").alias("site_id")), "site_id", "left_anti"
    ).select(F.lit("current").alias("edition"), "site_id")
    only_old = (
        old.join(new.withColumnRenamed("site_id", "site_id_current"), "site_id_current", "left_anti")
        .select(F.lit("prior").alias("edition"), F.coalesce("site_id_current", "site_id").alias("site_id"))
        .distinct()
    )
    return only_new.unionByName(only_old)


def differing_months(flagged: DataFrame, data_by_month: DataFrame) -> DataFrame:
    """Monthly rows behind the series years that differ between the editions."""
    keys = [*_PAIR_KEYS, "range_id"]
    return data_by_month.join(flagged.where("value_differs").select(*keys).distinct(), keys, "left_semi")


# --- cross-tabulation --------------------------------------------------------------


def edition_wide(
    series: DataFrame, survey_type: DataFrame, value: str = "rr", years: Iterable[int] = EDITION_WIDE_YEARS
) -> DataFrame:
    """Mean value per site and survey type, one column per year, original sites only."""
    per_year = [mean_where(F.col(value), F.col("year") == y).alias(str(y)) for y in years]
    wide = (
        series.where(F.col("site_permutation") == ORIGINAL_PERMUTATION)
        .groupBy("site_id", "site_permutation", "survey_type_id")
        .agg(*per_year)
    )
    types = survey_type.select(F.col("id").alias("survey_type_id"), F.col("name").alias("search_type"))
    return wide.join(types, "survey_type_id").select(
        "site_id", "site_permutation", "search_type", *[f"`{y}`" for y in years]
    )


def edition_long(series: DataFrame, survey_type: DataFrame, value: str = "rr") -> DataFrame:
    """The same values as rows."""
    types = survey_type.select(F.col("id").alias("survey_type_id"), F.col("name").alias("search_type"))
    return (
        series.where(F.col("site_permutation") == ORIGINAL_PERMUTATION)
        .join(types, "survey_type_id")
        .select("site_id", "site_permutation", "search_type", value)
    )
