"""Small hand-made cases: NULL rules, zero denominators, gaps, key collisions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldloom.constants import SurveyScope
from fieldloom.operators import editions, export, methods, monthly, quality, regions, taxa, yearly
from fieldloom.plans import catalog

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- surveys -----------------------------------------------------------------------


def test_scope_is_inclusive_and_drops_unknown_sources(spark):
    survey = spark.createDataFrame(
        [(1, D(1999, 1, 10), 1, 5), (2, D(1999, 1, 11), 1, 5), (3, D(2021, 12, 31), 2, 5), (4, D(2022, 1, 1), 1, 5),
         (5, D(2000, 1, 1), 1, None), (6, D(2000, 1, 1), 1, 36), (7, D(2000, 1, 1), 3, 5)],
        "id long, start_date date, survey_type_id int, source_id int",
    )
    assert rows(monthly.valid_surveys(survey), "id") == [(2,), (3,)]
    assert rows(monthly.valid_surveys(survey, SurveyScope(survey_types=None)), "id") == [(2,), (3,), (7,)]


def test_last_day_counts_to_its_end(spark):
    survey = spark.createDataFrame(
        [(1, dt.datetime(2021, 12, 31, 23, 59), 1, 5)], "id long, start_date timestamp_ntz, survey_type_id int, source_id int"
    )
    assert monthly.valid_surveys(survey).count() == 1


# --- the prior edition ---------------------------------------------------------------


@pytest.mark.parametrize("name", ["prior_edition", "prior_sites_attributed", "prior_all_zero_series", "rate_delta"])
def test_the_prior_edition_holds_every_supplier(spark, tmp_path, name):
    spark.createDataFrame(
        [(i, i, i, 1, "R" if i % 2 else "N", 5.0, D(1997, 3, 1)) for i in range(1, 41)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_quantity double, l_shipdate date",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(i, "Brand#11", "PROMO", 1) for i in range(1, 41)], "p_partkey long, p_brand string, p_type string, p_size int"
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i, f"S{i}") for i in range(1, 41)], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    found = [r["site_id"] for r in catalog.run(name, spark, str(tmp_path)).select("site_id").collect()]
    if name == "rate_delta":
        # pairs go by the current site at the old one's centroid
        assert len({*found} & {5, 22, 39}) == 3
    else:
        assert sorted(found) == list(range(1, 41))


def test_other_sources_of_the_prior_edition_are_left_out(spark):
    raw = spark.createDataFrame(
        [(1998, 1, 1, "u1a  ", 3, 0.12345, source, 1, 2.0, 3.0, 4) for source in (23, 24, None)],
        "start_date_y int, site_id long, search_type_id int, taxon_id string, response_variable_type_id int, value double, "
        "source_id int, unit_id int, lat double, lon double, survey_count long",
    )
    assert rows(editions.load_prior_edition(raw), "source_id", "taxon_id") == [(23, "u1a")]


# --- monthly response variables ----------------------------------------------------

SITE = "site_id long, site_type int, site_permutation string"
SURVEYS = "year int, month int, site_id long, taxon_id string, range_id int, num_surveys long"
SIGHTINGS = (
    "year int, month int, site_id long, taxon_id string, range_id int, num_sightings long, num_po_sightings long, "
    "mean_of_count double, sum_of_count long"
)


@pytest.fixture()
def months(spark):
    sites = spark.createDataFrame([(1, 1, "original")], SITE)
    surveys = spark.createDataFrame(
        [(2000, m, 1, "u1", 1, n) for m, n in ((1, 4), (2, 2), (3, 1), (4, 1), (5, 3))], SURVEYS
    )
    sightings = spark.createDataFrame(
        [
            (2000, 1, 1, "u1", 1, 2, 0, 3.0, 6),
            (2000, 2, 1, "u1", 1, 2, 2, None, None),  # presence only
            (2000, 3, 1, "u1", 1, 3, 1, 2.0, 4),  # no survey left to count in
            (2000, 4, 1, "u1", 1, 4, 2, 2.0, 4),  # fewer than none
            (2000, 5, 1, "u2", 1, 1, 0, 1.0, 1),  # another taxon
        ],
        SIGHTINGS,
    )
    return surveys, sightings, sites


def test_monthly_values(months):
    got = rows(
        monthly.data_by_month(*months), "month", "num_sightings", "rr", "mean_of_count", "mean_abundance", "abundance_surveys"
    )
    assert got == [
        (1, 2, 0.5, 3.0, 1.5, 4),
        (2, 2, 1.0, 0.0, 0.0, 0),
        (3, 3, 3.0, 2.0, 0.0, 0),
        (4, 4, 4.0, 2.0, -4.0, -1),
        (5, 0, 0.0, 0.0, 0.0, 3),
    ]


def test_strict_month_raises_on_a_zero_denominator(months):
    surveys, sightings, sites = months
    with pytest.raises(PySparkException):
        monthly.data_by_month(surveys, sightings, sites, strict=True).collect()
    # without a sum there is nothing to divide
    calm = sightings.where("month <= 2")
    assert monthly.data_by_month(surveys, calm, sites, strict=True).count() == 5


def test_years_are_unweighted_means_of_months(months):
    got = rows(yearly.data_by_year(monthly.data_by_month(*months)), "num_surveys", "num_sightings", "mean_monthly_rr")
    assert got == [(11, 11, pytest.approx(8.5 / 5))]


def test_fan_out_does_not_inflate_counts(spark):
    """A site in two taxa and two ranges of one species: a sighting counts once for each, not four times."""
    survey = spark.createDataFrame([(1, D(2000, 5, 1), 1, 1, 5)], "id long, start_date date, survey_point_id long, survey_type_id int, source_id int")
    point = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double")
    places = spark.createDataFrame([(0.0, 0.0, 9, 1)], "x double, y double, site_id long, site_type int")
    located = spark.createDataFrame(
        [(9, 1, 3, t, r) for t in ("a", "b") for r in (1, 2)], "site_id long, site_type int, sp_id int, taxon_id string, range_id int"
    )
    sighting = spark.createDataFrame([(1, 3, 2), (1, 3, None), (1, 4, 7)], "survey_id long, species_id int, individual_count int")
    species = spark.createDataFrame([(3,), (4,)], "sp_id int")
    ranges = located.select("sp_id", "taxon_id", "range_id")
    got = monthly.sightings_by_month(survey, sighting, point, places, located, species, ranges)
    assert rows(got, "taxon_id", "range_id", "num_sightings", "num_po_sightings", "mean_of_count", "sum_of_count") == [
        (t, r, 2, 1, 2.0, 2) for t in ("a", "b") for r in (1, 2)
    ]
    counted = monthly.surveys_by_month(survey, point, places, located)
    assert rows(counted, "taxon_id", "range_id", "num_surveys") == [(t, r, 1) for t in ("a", "b") for r in (1, 2)]


def test_a_place_with_most_surveys(spark):
    """Two thirds of the surveys at one point and all sightings of them of one species."""
    n = 30000
    survey = spark.range(n).selectExpr(
        "id", "date_add(DATE'2000-01-01', CAST(id % 366 AS INT)) AS start_date",
        "CASE WHEN id % 3 < 2 THEN 0 ELSE id % 50 END AS survey_point_id", "1 AS survey_type_id", "5 AS source_id",
    )
    point = spark.range(50).selectExpr("id", "CAST(id AS DOUBLE) AS x", "0D AS y")
    places = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS x", "0D AS y", "id AS site_id", "1 AS site_type")
    located = spark.range(50).selectExpr("id AS site_id", "1 AS site_type", "3 AS sp_id", "'a' AS taxon_id", "1 AS range_id")
    sighting = spark.range(2 * n).selectExpr(f"id % {n} AS survey_id", "3 AS species_id", "1 AS individual_count")
    species = spark.createDataFrame([(3,)], "sp_id int")
    ranges = located.select("sp_id", "taxon_id", "range_id")
    surveys = monthly.surveys_by_month(survey, point, places, located)
    sightings = monthly.sightings_by_month(survey, sighting, point, places, located, species, ranges)
    assert surveys.agg(F.sum("num_surveys")).first()[0] == n
    assert sightings.agg(F.sum("num_sightings")).first()[0] == 2 * n
    assert surveys.groupBy("year", "month").agg(F.count("*")).count() == 12


# --- flags -------------------------------------------------------------------------


def test_all_zero_series_spans_ranges_and_skips_null_keys(spark):
    series = spark.createDataFrame(
        [("a", 1, 1, 1, 0.0), ("a", 1, 1, 2, 0.0), ("a", 2, 1, 1, 0.0), ("a", 2, 1, 2, 0.5), ("a", None, 1, 1, 0.0)],
        "taxon_id string, site_id long, survey_type_id int, range_id int, v double",
    )
    got = rows(yearly.flag_all_zero(series, "v"), "site_id", "range_id", "all0_values")
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, None), (2, 2, None), (None, 1, None)]


def test_response_variable_never_repeats_rows(spark):
    series = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "taxon_id string, survey_type_id int")
    method = spark.createDataFrame(
        [("a", 1, 3, 3, 1), ("a", 1, 3, 3, 2), ("a", 2, 3, 1, 1), ("b", 1, 1, 3, 1), ("b", None, 3, 3, 1)],
        "taxon_id string, search_type_id int, response_variable_type_id int, unit_type_id int, unit_id int",
    )
    got = rows(yearly.assign_response_variable(series, method), "taxon_id", "survey_type_id", "response_variable_type_id")
    assert got == [("a", 1, 3), ("a", 2, None), ("b", 1, None)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (None, None), (None, None)], "k int, t string")
    assert rows(quality.unique_key_violations(df, ["k", "t"]), "k", "t", "n") == [(1, "a", 2), (3, None, 1), (None, None, 2)]
    assert rows(quality.unique_key_violations(df, ["k", "t"], allow_null=True), "k", "t", "n") == [(1, "a", 2)]


def test_unlisted_taxa_have_no_focal_flag(spark):
    taxonomy = spark.createDataFrame([("a", 9), ("b", 9)], "taxon_id string, focal int")
    listed = spark.createDataFrame([("a", 1)], "taxon_id string, focal int")
    assert rows(taxa.flag_focal_taxa(taxonomy, listed), "taxon_id", "focal") == [("a", 1), ("b", None)]


# --- editions ----------------------------------------------------------------------

SERIES = (
    "site_id long, survey_type_id int, site_permutation string, year int, taxon_id string, range_id int, "
    "num_surveys long, num_sightings long, mean_monthly_rr double, monthly_mean_abundance double, "
    "response_variable_type_id int"
)
PRIOR = (
    "start_date_y int, site_id long, search_type_id int, taxon_id string, response_variable_type_id int, value double, "
    "source_id int, unit_id int, lat double, lon double, survey_count long, site_id_current long"
)


def current(site, survey_type, year, rr, range_id=1, taxon="u1", permutation="original"):
    return (site, survey_type, permutation, year, taxon, range_id, 2, 1, rr, 0.0, 3)


def prior(site, survey_type, year, value, taxon="u1", site_id_current=None, unit=1):
    return (year, site, survey_type, taxon, 3, value, 23, unit, 0.0, 0.0, 2, site if site_id_current is None else site_id_current)


def test_ids_that_run_together_stay_apart(spark):
    """Site 1, type 12 and site 11, type 2 must not share an answer."""
    series = spark.createDataFrame([current(1, 12, 2000, 0.5), current(11, 2, 2000, 0.5)], SERIES)
    old = spark.createDataFrame([prior(1, 12, 2000, 0.5), prior(11, 2, 2000, 0.9), prior(1, 12, 2010, 0.5)], PRIOR)
    got = rows(editions.flag_value_differs(series, old), "site_id", "value_differs")
    assert got == [(1, False), (11, True)]


def test_difference_rules(spark):
    series = spark.createDataFrame(
        [
            current(1, 1, 2000, 0.33333), current(1, 1, 2000, 0.9, range_id=2),  # equal at four decimals, reaches range 2
            current(1, 1, 2001, 0.5),  # two prior values, one equal
            current(1, 1, 2002, 0.5),  # no counterpart
            current(1, 1, 1998, 0.5),  # too early
            current(1, 1, 2010, 0.5),  # the prior edition's last year
        ],
        SERIES,
    )
    old = spark.createDataFrame(
        [prior(1, 1, 2000, 0.3333), prior(1, 1, 2001, 0.1), prior(1, 1, 2001, 0.5, unit=2), prior(1, 1, 1998, 0.1),
         prior(1, 1, 2010, 0.1)],
        PRIOR,
    )
    got = rows(editions.flag_value_differs(series, old), "year", "range_id", "value_differs")
    assert got == [(1998, 1, None), (2000, 1, False), (2000, 2, False), (2001, 1, False), (2002, 1, None), (2010, 1, None)]


def test_completeness_of_a_series_with_a_gap(spark):
    series = spark.createDataFrame(
        [current(1, 1, y, 0.5) for y in (2000, 2001, 2003)] + [current(2, 1, y, 0.0) for y in (2000, 2001)], SERIES
    )
    sites = spark.createDataFrame([(1, 1, "original"), (2, 1, "original")], SITE)
    types = spark.createDataFrame([(1, "2ha")], "id int, name string")
    got = rows(
        editions.current_series_summary(series, sites, types),
        "site_id", "ts_sample_years", "ts_length", "ts_completeness", "ts_completeness_exact", "num_0s",
    )
    assert got == [(1, 3, 4, 0, 75.0, 0), (2, 2, 2, 100, 100.0, 2)]
    # several units under one current site: more rows than years
    old = spark.createDataFrame([prior(1, 1, y, 0.5, unit=u) for y in (2000, 2001) for u in (1, 2)], PRIOR)
    assert rows(editions.prior_series_summary(old, sites, types), "ts_completeness") == [(200,)]


def test_an_edition_equals_itself(spark):
    series = spark.createDataFrame([current(s, 1, y, s / 7) for s in (1, 2) for y in (2000, 2001, 2002)], SERIES)
    old = spark.createDataFrame([prior(s, 1, y, round(s / 7, 4)) for s in (1, 2) for y in (2000, 2001, 2002)], PRIOR)
    sites = spark.createDataFrame([(1, 1, "original"), (2, 1, "original")], SITE)
    types = spark.createDataFrame([(1, "2ha")], "id int, name string")
    names = spark.createDataFrame([("u1", "One")], "taxon_id string, taxon_name string")
    assert editions.flag_value_differs(series, old).where("value_differs").count() == 0
    a = editions.current_series_summary(series, sites, types)
    b = editions.prior_series_summary(old, sites, types)
    assert rows(editions.non_matching_series(a, b, names), "total_ts", "num_unequal_ts", "percentage_unequal_ts") == [(2, 0, 0.0)]
    assert editions.unmatched_sites(series, old).count() == 0


def test_prior_sites_take_the_lowest_match_of_their_type(spark):
    ring = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    vertex = spark.createDataFrame(
        [(s, 1, 1, i, float(x), float(y)) for s in (5, 6, 7) for i, (x, y) in enumerate(ring, 1)],
        "site_id long, part int, ring int, seq int, x double, y double",
    )
    sites = spark.createDataFrame([(5, 2, "original"), (6, 1, "original"), (7, 1, "original")], SITE)
    old = spark.createDataFrame(
        [(2000, 90, 1, "u1", 3, 0.1, 23, 1, 1.0, 1.0, 1), (2000, 91, 1, "u1", 3, 0.1, 23, 1, 9.0, 9.0, 1),
         (2000, None, 1, "u1", 3, 0.1, 23, 1, 1.0, 1.0, 1)],
        PRIOR.rsplit(",", 1)[0],
    )
    got = rows(editions.back_attribute_sites(old, sites, vertex), "site_id", "site_id_current")
    assert got == [(90, 6), (91, None), (None, None)]


def test_prior_edition_is_typed_and_rounded(spark):
    raw = spark.createDataFrame(
        [(2000, 1, 1, "u1      ", 3, 0.123449, 23, 1, 150.0, -30.0, 4), (2000, 1, 1, "u2", 3, 0.5, 22, 1, 150.0, -30.0, 4)],
        "start_date_y int, site_id int, search_type_id int, taxon_id string, response_variable_type_id int, value double, "
        "source_id int, unit_id int, centroid_x double, centroid_y double, survey_count int",
    )
    got = rows(editions.load_prior_edition(raw), "taxon_id", "value", "lon", "lat")
    assert got == [("u1", 0.1234, 150.0, -30.0)]


def test_wide_and_long_agree(spark):
    series = spark.createDataFrame(
        [current(1, 1, 2000, 0.25), current(1, 1, 2002, 0.75), current(2, 1, 2001, 0.5, permutation="buffered")], SERIES
    ).withColumnRenamed("mean_monthly_rr", "rr")
    types = spark.createDataFrame([(1, "2ha")], "id int, name string")
    wide = editions.edition_wide(series, types, years=range(2000, 2003)).collect()
    assert [r.asDict() for r in wide] == [
        {"site_id": 1, "site_permutation": "original", "search_type": "2ha", "2000": 0.25, "2001": None, "2002": 0.75}
    ]
    assert rows(editions.edition_long(series, types), "site_id", "rr") == [(1, 0.25), (1, 0.75)]


def test_given_nearest_region_fills_only_empty_rows(spark):
    wide = spark.createDataFrame(
        [(1, None, None, None, 0.5), (2, "b", 1.0, 2.0, 0.5), (3, None, None, None, 0.5)],
        "site_id long, region_name string, region_centroid_longitude double, region_centroid_latitude double, `2000` double",
    )
    names = spark.createDataFrame([(1, "a", "A")], "region_id int, region_name string, region_code string")
    ring = [(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)]
    vertex = spark.createDataFrame(
        [(1, 1, 1, i, float(x), float(y)) for i, (x, y) in enumerate(ring, 1)],
        "region_id int, part int, ring int, seq int, x double, y double",
    )
    nearest = spark.createDataFrame([(1, "A"), (2, "A")], "site_id long, region_code string")
    got = rows(
        regions.fill_nearest_region(wide, nearest, names, vertex),
        "site_id", "region_name", "region_centroid_longitude", "region_centroid_latitude",
    )
    assert got == [(1, "a", 2.0, 1.0), (2, "b", 1.0, 2.0), (3, None, None, None)]


# --- export ------------------------------------------------------------------------

AGG = (
    "time_series_id string, taxon_id string, source_id int, search_type_id int, region_id int, "
    "experimental_design_type_id int, start_date_y int, value double"
)
DETAILS = (
    "taxon_id string, source_id int, start_year int, end_year int, exclude_from_analysis boolean, data_agreement_id int, "
    "standardisation_of_method_effort_id int, consistency_of_monitoring_id int"
)


def series_rows(name, taxon="a", source=1, search=1, region=1, design=1, values=((2000, 0.0), (2001, 0.5), (2002, 0.0))):
    return [(name, taxon, source, search, region, design, y, v) for y, v in values]


def test_null_rules_of_the_filter(spark):
    agg = spark.createDataFrame(
        series_rows("good") + series_rows("no search type", search=None) + series_rows("incidental", search=6)
        + series_rows("no region", region=None) + series_rows("no details", source=9) + series_rows("excluded", source=2)
        + series_rows("unknown scores", source=3) + series_rows("bad score", source=4)
        + series_rows("unknown status", taxon="b") + series_rows("failing status", taxon="c")
        + series_rows("all zero", values=((2000, 0.0), (2001, 0.0), (2002, 0.0)))
        + series_rows("too short", values=((2000, 0.5), (2000, 0.7), (2001, 0.5))) + series_rows("other design", design=2)
        + series_rows("out of bounds", source=5),
        AGG,
    )
    taxon = spark.createDataFrame([("a", 5), ("b", None), ("c", 7)], "id string, max_status_id int")
    details = spark.createDataFrame(
        [(t, 1, None, None, False, 1, 2, 2) for t in "abc"]
        + [("a", 2, None, None, True, 1, 2, 2), ("a", 3, None, None, False, None, None, None),
           ("a", 4, None, None, False, 0, 2, 2), ("a", 5, 2001, None, False, 1, 2, 2)],
        DETAILS,
    )
    got = export.qualifying_time_series(agg, taxon, details, 1990, 2020, 3)
    assert rows(got, "time_series_id") == [("good",), ("no search type",), ("unknown scores",)]

    more = agg.unionByName(spark.createDataFrame([(None, "a", 1, 1, 1, 1, 2000, 0.5), (None, "a", 1, 1, 1, 1, 1980, 0.5)], AGG))
    flags = export.flag_include_in_analysis(more, details, got, 1990, 2020)
    assert flags.count() == more.count()
    by_id = {r[0]: r[1] for r in flags.where("start_date_y = 2000").select("time_series_id", "include_in_analysis").collect()}
    assert by_id["good"] is True and by_id["excluded"] is False and by_id[None] is None
    # a year out of bounds decides even where the series is unknown
    assert rows(flags.where("start_date_y = 1980"), "include_in_analysis") == [(False,)]


def test_absences_never_meet_detections(spark):
    survey = spark.createDataFrame([(1,), (2,)], "id long")
    survey_site = spark.createDataFrame([(1, 7), (2, 7), (2, 8)], "survey_id long, site_id long")
    processed = spark.createDataFrame([(11, 1, 1), (12, 2, 1), (13, 2, 2)], "id long, raw_survey_id long, experimental_design_type_id int")
    expected = spark.createDataFrame([("a", 7), ("b", 8)], "taxon_id string, site_id long")
    seen = spark.createDataFrame([(1, 11, "a")], "id long, survey_id long, taxon_id string")
    got = export.implied_absences(survey, survey_site, processed, expected, seen)
    assert rows(got, "processed_survey_id", "taxon_id") == [(12, "a"), (12, "b")]
    one = export.implied_absences(survey, survey_site, processed, expected, seen, taxon_id="b")
    assert rows(one, "processed_survey_id", "taxon_id") == [(12, "b")]


def test_site_labels_and_shares(spark):
    agg = spark.createDataFrame(
        [(1, None, 1), (2, None, 1), (2, None, 2), (3, None, 2), (None, 40, 1)], "site_id long, grid_cell_id long, data_type int"
    )
    first = spark.createDataFrame([(1, "One"), (2, None)], "id long, name string")
    second = spark.createDataFrame([(2, "Plot")], "id long, name string")
    got = rows(export.with_site_names(agg, first, second), "site_or_cell_id", "data_type", "site_name")
    assert got == [(1, 1, "One"), (2, 1, "site_1_2"), (2, 2, "Plot"), (3, 2, "site_2_3"), (40, 1, "grid_40")]

    facts = spark.createDataFrame([(t, 1, 1) for t in "abcd"], "taxon_id string, source_id int, data_type int")
    taxon = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", None)], "id string, suppress_spatial_representativeness boolean")
    hull = spark.createDataFrame(
        [("a", 1, 1, 1.0, 3.0), ("b", 1, 1, 1.0, 0.0), ("c", 1, 1, 1.0, 3.0), ("d", 1, 1, 2.0, 3.0)],
        "taxon_id string, source_id int, data_type int, alpha_hull_area_in_m2 double, core_range_area_in_m2 double",
    )
    shares = rows(export.with_spatial_representativeness(facts, taxon, hull), "taxon_id", "spatial_representativeness")
    assert shares == [("a", None), ("b", None), ("c", 0.3333), ("d", 0.6667)]


def test_export_of_one_taxon_with_a_condition(spark, tables_dir):
    from fieldloom.plans.catalog import Workload
    from fieldloom.sources.star import StarTables

    w = Workload(StarTables(spark, tables_dir))
    all_rows = export.time_series_export(w.t.agg_export, w.dims, 1996, 1999)
    taxon = all_rows.first().taxon_id
    one = export.time_series_export(
        w.t.agg_export, w.dims, 1996, 1999, taxon_id=taxon, where=F.col("value") > 0, having=F.col("value_count") >= 2
    )
    assert one.count() > 0
    assert {r.taxon_id for r in one.collect()} == {taxon}
    for r in one.collect():
        assert len(r.values_by_year) == r.value_count >= 2
        assert set(r.values_by_year) <= set(range(1996, 2000)) and min(r.values_by_year.values()) > 0
        assert r.value_series == ",".join(f"{y}={v}" for y, v in sorted(r.values_by_year.items()))
    assert len(all_rows.columns) == 52


# --- methods -----------------------------------------------------------------------


def profile_rows(spark, items):
    return methods.append_profiles(
        spark.createDataFrame(items, "taxon_id string, unit_id int, unit_type_id int, source_id int, search_type_id int, data_type int")
    )


def test_profile_defaults_and_classes(spark):
    table = profile_rows(spark, [("a", 1, 3, 178, 1, 1), ("a", 1, 3, 5, 1, 1), ("a", 1, 2, 5, 1, 1)])
    assert rows(table, "response_variable_type_id", "matches_previous", "is_orphan")[0] == (0, False, False)
    got = rows(methods.classify_response_variable(table), "source_id", "unit_type_id", "response_variable_type_id")
    assert got == [(178, 3, 2), (5, 2, 1), (5, 3, 3)]


def test_orphans_and_previous_methods(spark):
    current_methods = methods.classify_response_variable(
        profile_rows(spark, [("a", 1, 3, 5, 1, 1), ("a", 1, 3, 5, None, 1), ("b", 1, 2, 5, 1, 1)])
    )
    previous = spark.createDataFrame(
        [("a", 1, 5, 1, 3, 1, 1), ("a", 1, 5, None, 3, 1, 1), ("b", 1, 5, 1, 3, 1, 1), ("z", 2, 5, 1, 1, 1, 1),
         ("a", 15, 5, 1, 1, 1, 1), ("a1", 5, 5, 1, 1, 1, 1)],
        "taxon_id string, unit_id int, source_id int, search_type_id int, response_variable_type_id int, data_type int, "
        "experimental_design_type_id int",
    )
    taxon = spark.createDataFrame([("a", 4), ("b", None), ("a1", 2)], "id string, max_status_id int")
    orphans = methods.orphan_methods(previous, current_methods, taxon)
    # a NULL search type matches nothing; "a" + 15 and "a1" + 5 are two combinations
    assert rows(orphans, "taxon_id", "unit_id", "search_type_id", "taxon_defunct") == [
        ("a", 1, None, False), ("a", 15, 1, False), ("a1", 5, 1, False), ("z", 2, 1, True)
    ]
    strict = methods.orphan_methods(previous, current_methods, taxon, null_safe=True)
    assert ("a", 1, None) not in rows(strict, "taxon_id", "unit_id", "search_type_id")
    table = methods.attach_previous_method(methods.append_profiles(current_methods, orphans), previous)
    assert table.count() == 7
    got = rows(table.where("NOT is_orphan"), "taxon_id", "search_type_id", "response_variable_type_id_previous", "matches_previous")
    assert got == [("a", 1, 3, True), ("a", None, 0, False), ("b", 1, 3, False)]
    # an orphan keeps variable 0, so it never matches what it was
    assert {r.matches_previous for r in table.where("is_orphan").collect()} == {False}


def test_months_of_unknown_date(spark):
    source = spark.createDataFrame([(5,)], "id int")
    survey = spark.createDataFrame(
        [(1, 5, 7, 2000, 1), (2, 5, 7, 2000, None), (3, 5, 7, 2000, None), (4, 5, 7, None, 3), (5, 6, 7, 2000, 1)],
        "id long, source_id int, site_id long, start_date_y int, start_date_m int",
    )
    sighting = spark.createDataFrame(
        [(i, "a", 1, 3, c) for i, c in ((1, 2.0), (2, 2.0), (3, None), (4, 5.0), (5, 1.0))],
        "survey_id long, taxon_id string, unit_id int, unit_type_id int, count double",
    )
    site = spark.createDataFrame([(7, 1)], "id long, search_type_id int")
    taxon = spark.createDataFrame([("a", 4)], "id string, max_status_id int")
    got = rows(
        methods.method_profile_direct(source, survey, sighting, site, taxon),
        "survey_id_count", "site_id_count", "n_count_values", "min_count", "max_count", "n_months", "n_years",
    )
    assert got == [(4, 1, 2, 2.0, 5.0, 2, 1)]


def test_sightings_of_repeated_surveys_points_and_sites_are_told_each(spark):
    """Keys that repeat multiply as in a plain join; a null type, point or species meets nothing."""
    day = "2000-05-05"
    survey = spark.createDataFrame(
        [(1, day, 10, 1, 1), (1, day, 11, 1, 1), (2, day, 10, 2, 1), (3, day, 12, None, 1), (4, day, None, 1, 1)],
        "id long, start_date string, survey_point_id long, survey_type_id int, source_id int",
    )
    points = spark.createDataFrame([(10, 0.0, 0.0), (10, 1.0, 0.0), (11, 0.0, 0.0), (12, 0.0, 0.0)], "id long, x double, y double")
    places = spark.createDataFrame(
        [(0.0, 0.0, 7, 1), (0.0, 0.0, 7, 1), (0.0, 0.0, 8, 1), (1.0, 0.0, 8, 1), (0.0, 0.0, 9, 2), (0.0, 0.0, 9, None)],
        "x double, y double, site_id long, site_type int",
    )
    located = spark.createDataFrame(
        [(7, 1, 5, "a", 1), (7, 1, 5, "a", 2), (8, 1, 5, "b", 1), (9, 2, 5, "a", 1), (8, 1, 6, "c", 1)],
        "site_id long, site_type int, sp_id int, taxon_id string, range_id int",
    )
    sighting = spark.createDataFrame(
        [(100, 1, 5, 2), (101, 1, 6, None), (101, 1, 6, None), (102, 2, 5, 1), (103, 3, 5, 1), (104, 4, 5, 1), (105, 1, None, 1), (106, 2, 6, 1)],
        "id long, survey_id long, species_id int, individual_count int",
    )
    scope = SurveyScope("2000-01-01", "2000-12-31", (3,), None)
    surveys, at, over = ([tuple(r) for r in d.collect()] for d in (survey, points, places))
    inside = {(r.site_id, r.site_type, r.sp_id) for r in located.collect()}
    want = list(
        (i, s, sp, n, site)
        for i, s, sp, n in map(tuple, sighting.collect()) for sid, _, point, kind, _ in surveys if sid == s
        for pid, x, y in at if pid == point for px, py, site, type_ in over
        if (px, py) == (x, y) and kind == type_ and (site, type_, sp) in inside
    )
    got = monthly.sightings_in_sites(survey, sighting, points, places, located, [5, 6], scope)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 8
    counted = {}
    for _, _, sp, n, site in want:
        a = counted.setdefault((site, sp), [0, 0, None])
        a[0] += 1
        a[1] += n is None
        a[2] = a[2] if n is None else (a[2] or 0) + n
    whole = monthly.sightings_per_site(survey, sighting, points, places, [5, 6], scope)
    ranged = monthly.sightings_per_site(survey, sighting, points, places, [5, 6], scope, located)
    rows = {(r.site_id, r.sp_id): [r.num_sightings, r.num_po_sightings, r.sum_of_count] for r in ranged.collect()}
    assert rows == counted
    assert {k: v for k, v in ((((r.site_id, r.sp_id)), [r.num_sightings, r.num_po_sightings, r.sum_of_count]) for r in whole.collect()) if k in rows} == rows
    assert whole.count() > ranged.count()
    per_site = {(r.site_id, r.site_type): r.num_surveys for r in monthly.surveys_per_site(survey, points, places, scope).collect()}
    assert per_site == {(7, 1): 4, (8, 1): 3, (9, 2): 1}


def test_profiles_of_repeated_surveys_and_null_parts(spark):
    """A survey id that repeats with other sites counts once, as do sites, months, years and counts; nulls do not count."""
    surveys = [(1, 1, 10, 2000, 1), (1, 1, 11, 2000, None), (2, 1, 10, 2001, 1), (3, 1, None, None, 4), (4, None, 10, 2000, 1), (5, 1, 12, 2000, 0)]
    survey = spark.createDataFrame(surveys, "id long, source_id int, site_id long, start_date_y int, start_date_m int")
    survey = survey.withColumn("search_type_id", F.lit(None).cast("int"))
    sighting = spark.createDataFrame(
        [(1, 1, 1, None, 2.0), (2, 1, 1, None, None), (3, 2, 1, None, 2.0), (4, 3, 1, None, 3.0), (5, 3, 1, 1, None), (6, 4, 1, 1, 1.0), (7, 5, 1, None, 0.0), (8, 5, 1, None, -0.0)],
        "id long, survey_id long, unit_id int, unit_type_id int, count double",
    )
    link = spark.createDataFrame([(i, "a") for i in range(1, 9)] + [(2, "b")], "sighting_id long, taxon_id string")
    taxon = spark.createDataFrame([("a", 1), ("b", None)], "id string, max_status_id int")
    source = spark.createDataFrame([(1,)], "id int")
    rows = methods.method_profile_linked(source, survey, sighting, link, taxon).collect()
    got = {
        (r.taxon_id, r.unit_type_id): (r.survey_id_count, r.site_id_count, r.n_months, r.n_years, r.n_count_values, r.min_count, r.max_count) for r in rows
    }
    assert got == {
        ("a", None): (4, 3, 3, 2, 3, 0.0, 3.0),
        ("a", 1): (1, 0, 0, 0, 0, None, None),
        ("b", None): (1, 2, 2, 1, 0, None, None),
    }
