"""Monthly facts: surveys, sightings, and the response variables they give.

Facts are counted before they fan out.  Surveys shrink to counts per point, then
per place, then per site, and only then meet the taxa of the site; sightings meet
their survey once and shrink to counts per site and species.  A place that holds a
third of all surveys is by then a handful of rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.constants import FOCAL_SPECIES, SurveyScope
from fieldloom.functions.rates import ratio
from fieldloom.operators import geo
from fieldloom.operators.taxa import RANGE_KEYS

MONTH_KEYS = ["year", "month", "site_id", "taxon_id", "range_id"]


def valid_surveys(survey: DataFrame, scope: SurveyScope = SurveyScope()) -> DataFrame:
    """Surveys within the dates, not from an excluded source, of the types in use.

    A survey without source is left out: "not one of these" is unknown for it.
    """
    day = F.col("start_date").cast("date")
    kept = day.between(F.lit(scope.start).cast("date"), F.lit(scope.end).cast("date"))
    kept &= ~F.col("source_id").isin(*scope.excluded_sources)
    if scope.survey_types is not None:
        kept &= F.col("survey_type_id").isin(*scope.survey_types)
    return survey.where(kept)


def sites_at_places(survey_point: DataFrame, sites: DataFrame, site_vertex: geo.Layer) -> DataFrame:
    """Sites over each distinct survey place: x, y, site_id, site_type.

    Places are deduplicated first: many points share one, and it needs one test.
    """
    places = survey_point.select("x", "y").distinct()
    inside = geo.points_in_polygons(places, site_vertex, ["site_id"]).distinct()
    return inside.join(sites.select("site_id", "site_type"), "site_id")


def sites_of_species(places: DataFrame, sites_in_ranges: DataFrame) -> DataFrame:
    """Sites over each place, for each species that has a range there: x, y, site_id, site_type, sp_id.

    Places and ranges are far fewer than sightings.  They meet first, so a sighting meets the
    sites of its species only, and nothing has to be sorted out after it was repeated.
    """
    return places.join(sites_in_ranges.select("site_id", "site_type", "sp_id").distinct(), ["site_id", "site_type"])


def _months_per_site(per_place: DataFrame, sites: DataFrame, place: list[str], site: list[str], counts: list[str]) -> DataFrame:
    """Monthly counts per place, summed over the places of each site: ``site``, year, month and ``counts``.

    The months of a place go to its sites as one row of arrays, which is shuffled once, by site:
    neither the keys of a site nor those of a row are repeated for every month.
    """
    listed = ["year", "month", *counts]
    months = per_place.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct(*listed))).alias("months"))
    return (
        months.select(*place, *[F.col(f"months.{c}").alias(c) for c in listed])
        .join(sites, [c for c in place if c in sites.columns])
        .select(*site, *listed)
        .repartition(*site)
        .select(*site, F.inline(F.arrays_zip(*listed)))
        .groupBy("year", "month", *site)
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def _points_on_sites(survey_point: DataFrame, places: DataFrame) -> DataFrame:
    """Survey points that lie in some site: the others, with all their surveys, leave at the first join."""
    points = survey_point.select(F.col("id").alias("survey_point_id"), "x", "y")
    return points.join(places.select("x", "y"), ["x", "y"], "left_semi")


def surveys_per_site(
    survey: DataFrame, survey_point: DataFrame, places: DataFrame, scope: SurveyScope = SurveyScope(survey_types=None)
) -> DataFrame:
    """Surveys per site, year and month; a survey counts for each site of its own type that its point lies in."""
    points = _points_on_sites(survey_point, places)
    when = [F.year("start_date").alias("year"), F.month("start_date").alias("month")]
    per_place = (
        valid_surveys(survey, scope)
        .groupBy("survey_point_id", F.col("survey_type_id").alias("site_type"), *when)
        .agg(F.count("id").alias("n"))
        .join(points, "survey_point_id")
        .groupBy("x", "y", "site_type", "year", "month")
        .agg(F.sum("n").alias("n"))
    )
    return _months_per_site(per_place, places, ["x", "y", "site_type"], ["site_id", "site_type"], ["n"]).withColumnRenamed(
        "n", "num_surveys"
    )


def surveys_by_month(
    survey: DataFrame,
    survey_point: DataFrame,
    places: DataFrame,
    sites_in_ranges: DataFrame,
    scope: SurveyScope = SurveyScope(survey_types=None),
) -> DataFrame:
    """Surveys per year, month, site, taxon and range class.

    A survey counts for each site of its own type that its point lies in
    (``places``, from ``sites_at_places``), and there for each taxon and range the
    site lies in.
    """
    per_site = surveys_per_site(survey, survey_point, places, scope)
    return per_site.join(sites_in_ranges, ["site_id", "site_type"]).select(*MONTH_KEYS, "num_surveys")


def _placed_surveys(survey: DataFrame, survey_point: DataFrame, places: DataFrame, scope: SurveyScope) -> DataFrame:
    """Surveys at places in some site: survey_id, site_type, year, month, x, y."""
    return (
        valid_surveys(survey, scope)
        .select(
            F.col("id").alias("survey_id"), "survey_point_id", F.col("survey_type_id").alias("site_type"),
            F.year("start_date").alias("year"), F.month("start_date").alias("month"),
        )
        .join(_points_on_sites(survey_point, places), "survey_point_id")
    )


#: Species that go into a scan's filter at most.
FEW_SPECIES = 4096


def _focal_sightings(sighting: DataFrame, species: DataFrame | Iterable[int]) -> DataFrame:
    """Sightings of the given species: a table with ``sp_id``, or ids.

    Focal species are a short list, so a table of at most FEW_SPECIES is read as ids when
    the plan is made, and the ids reach the scan as a filter: raw sightings are not
    shuffled by species.  A longer table is joined.
    """
    if isinstance(species, DataFrame):
        wanted = species.select(F.col("sp_id").alias("species_id")).distinct()
        listed = [r["species_id"] for r in wanted.limit(FEW_SPECIES + 1).collect()]
        if len(listed) > FEW_SPECIES:
            return sighting.join(wanted, "species_id", "left_semi").withColumnRenamed("species_id", "sp_id")
        species = [i for i in listed if i is not None]
    return sighting.where(F.col("species_id").isin(*species)).withColumnRenamed("species_id", "sp_id")


def sightings_in_sites(
    survey: DataFrame,
    sighting: DataFrame,
    survey_point: DataFrame,
    places: DataFrame,
    sites_in_ranges: DataFrame,
    species: DataFrame | Iterable[int] = FOCAL_SPECIES,
    scope: SurveyScope = SurveyScope(),
    sighting_id: str = "id",
) -> DataFrame:
    """Sightings of focal species in sites that lie in a range of the species.

    ``species`` lists the focal ``sp_id``, as a table or as ids.  The site's ranges only decide which sites a
    sighting goes to; joined in full they would repeat it for every taxon of the site.
    The rows multiply in the last join and are not shuffled behind it.
    """
    placed = _placed_surveys(survey, survey_point, places, scope).select("survey_id", "site_type", "x", "y")
    return (
        _focal_sightings(sighting, species)
        .join(placed, "survey_id")
        .join(sites_of_species(places, sites_in_ranges), ["x", "y", "site_type", "sp_id"])
        .select(sighting_id, "survey_id", "sp_id", "individual_count", "site_id")
    )


def taxon_sightings(sightings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every taxon and range class of the species, attached to each of its sightings.

    The fan-out is meant: rows off the site's own ranges find no survey row later.
    """
    return sightings.join(ranges.select(*RANGE_KEYS).distinct(), "sp_id")


def sightings_per_site(
    survey: DataFrame,
    sighting: DataFrame,
    survey_point: DataFrame,
    places: DataFrame,
    species: DataFrame | Iterable[int] = FOCAL_SPECIES,
    scope: SurveyScope = SurveyScope(),
    sites_in_ranges: DataFrame | None = None,
) -> DataFrame:
    """Sightings per site, species, year and month, with their presence-only number and their counts summed.

    Sightings meet their survey once and shrink per place before they meet the sites: those
    in a range of the species where ``sites_in_ranges`` is given, else all.
    """
    counts = ["num_sightings", "num_po_sightings", "sum_of_count"]
    per_place = (
        _focal_sightings(sighting, species)
        .select("survey_id", "sp_id", "individual_count")
        .join(_placed_surveys(survey, survey_point, places, scope), "survey_id")
        .groupBy("x", "y", "site_type", "year", "month", "sp_id")
        .agg(
            F.count("*").alias("num_sightings"),
            F.count(F.when(F.col("individual_count").isNull(), 1)).alias("num_po_sightings"),
            F.sum("individual_count").alias("sum_of_count"),
        )
    )
    sites = places if sites_in_ranges is None else sites_of_species(places, sites_in_ranges)
    return _months_per_site(per_place, sites, ["x", "y", "site_type", "sp_id"], ["site_id", "site_type", "sp_id"], counts)


def sightings_by_month(
    survey: DataFrame,
    sighting: DataFrame,
    survey_point: DataFrame,
    places: DataFrame,
    sites_in_ranges: DataFrame,
    species: DataFrame | Iterable[int] = FOCAL_SPECIES,
    ranges: DataFrame | None = None,
    scope: SurveyScope = SurveyScope(),
) -> DataFrame:
    """Sightings per year, month, site, taxon and range class.

    ``num_po_sightings`` are those without a count; ``mean_of_count`` and
    ``sum_of_count`` are over those with one.  All taxa of a species share its
    counts, so these are taken per site and species and attached to the taxa at
    the end.

    A sighting goes to every taxon and range class of its species (``ranges``).
    Without ``ranges`` it goes only to those that the site lies in, the rows that a
    monthly survey count can meet.
    """
    per_site = sightings_per_site(survey, sighting, survey_point, places, species, scope, sites_in_ranges)
    on_site = ["site_id", "site_type", "sp_id"]
    if ranges is None:
        per_taxon = per_site.join(sites_in_ranges, on_site)
    else:
        per_taxon = taxon_sightings(per_site.join(sites_in_ranges.select(*on_site), on_site, "left_semi"), ranges)
    return per_taxon.select(
        *MONTH_KEYS, "num_sightings", "num_po_sightings", mean_of_count().alias("mean_of_count"), "sum_of_count"
    )


def mean_of_count() -> Column:
    """Individuals per counted sighting."""
    return ratio(F.col("sum_of_count"), F.col("num_sightings") - F.col("num_po_sightings"))


def mean_abundance(strict: bool = False) -> Column:
    """Individuals per survey that could have counted them; see ``data_by_month``."""
    return ratio(F.col("sum_of_count"), F.col("num_surveys") - F.col("num_po_sightings"), strict)


def data_by_month(
    surveys_by_month: DataFrame, sightings_by_month: DataFrame, sites: DataFrame, strict: bool = False
) -> DataFrame:
    """Monthly response variables per site, taxon and range class.

    * ``rr``: sightings per survey
    * ``mean_of_count``: mean count where there was one, absences left out
    * ``mean_abundance``: individuals per survey that could have counted them,
      ``abundance_surveys`` (surveys less presence-only sightings), absences as 0

    Surveys with several sightings can bring ``abundance_surveys`` to 0 or below.
    At 0 the mean is taken as 0, or raises when ``strict``; below, it is kept as it
    comes out, and the column lets a reader find it.
    """
    sightings = sightings_by_month.select(
        *MONTH_KEYS, "num_sightings", "num_po_sightings", "mean_of_count", "sum_of_count"
    )
    attributes = sites.select("site_id", F.col("site_type").alias("survey_type_id"), "site_permutation")
    seen = F.coalesce(F.col("num_sightings"), F.lit(0))
    counting = F.col("num_surveys") - F.col("num_po_sightings")
    return (
        surveys_by_month.join(sightings, MONTH_KEYS, "left")
        .join(attributes, "site_id")
        .select(
            "site_id", "survey_type_id", "site_permutation", "year", "month", "taxon_id", "range_id", "num_surveys",
            seen.alias("num_sightings"),
            ratio(seen, F.col("num_surveys")).alias("rr"),
            F.coalesce("mean_of_count", F.lit(0.0)).alias("mean_of_count"),
            F.coalesce(mean_abundance(strict), F.lit(0.0)).alias("mean_abundance"),
            F.coalesce(counting, F.col("num_surveys")).alias("abundance_surveys"),
        )
    )
