"""The plans: over stored domain tables, with every broadcast off, as when nothing is small."""

from __future__ import annotations

import pytest

from fieldloom.operators import geo, methods, monthly
from fieldloom.plans import catalog
from fieldloom.plans.catalog import Workload, published
from fieldloom.sources.layers import open_layer
from fieldloom.sources.star import StarTables, store_layers, store_views
from fieldloom.sources.tables import save_bucketed

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def stored(spark, tables_dir, tmp_path_factory):
    return store_views(StarTables(spark, tables_dir), str(tmp_path_factory.mktemp("domain") / "tables"))


@pytest.fixture(scope="module")
def layered(stored):
    return store_layers(stored, "plan_layer")


@pytest.fixture()
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in OFF}
    for key, value in OFF.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def workload(stored) -> Workload:
    return Workload(stored, keep=lambda _name, df: df)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_query_needs_a_cross_join_or_a_python_row_loop(spark, tables_dir, stored, no_broadcast, name):
    plan = plan_of(catalog.QUERIES[name](workload(stored)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "BroadcastHashJoin"):
        assert operator not in plan, operator


@pytest.mark.parametrize(
    "name", ["data_by_year", "value_differs", "wide_reporting_rate_filled", "method_report", "time_series_export"]
)
def test_results_hold_without_broadcasts(spark, tables_dir, stored, no_broadcast, name):
    large = published(catalog.QUERIES[name](workload(stored))).collect()
    for key in OFF:
        spark.conf.unset(key)
    small = catalog.run(name, spark, tables_dir).collect()
    assert sorted(map(str, large)) == sorted(map(str, small))


def test_bucketed_sightings_are_not_shuffled(spark, tables_dir, stored, no_broadcast, tmp_path):
    w = workload(stored)
    sighting = save_bucketed(w.t.sighting, "bucketed_sighting", "survey_id", 8, str(tmp_path / "s"))
    places = w.t.survey_point.selectExpr("x", "y", "id AS site_id", "1 AS site_type").distinct()
    located = places.selectExpr("site_id", "site_type", "1 AS sp_id", "'a' AS taxon_id", "1 AS range_id").distinct()

    def plan(table):
        return plan_of(
            monthly.sightings_by_month(w.t.survey, table, w.t.survey_point, places, located, [1, 2, 3], scope=catalog.SCOPE)
        )

    by_survey = "Exchange hashpartitioning(survey_id"
    assert plan(w.t.sighting).count(by_survey) == 2
    assert plan(sighting).count(by_survey) == 1
    spark.sql("DROP TABLE bucketed_sighting")


def test_filters_and_columns_reach_the_scan(spark, tables_dir, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    w = workload(stored)
    plan = plan_of(monthly.valid_surveys(w.t.survey, catalog.SCOPE).select("id"))
    for filtered in ("GreaterThanOrEqual(start_date", "LessThanOrEqual(start_date", "In(survey_type_id", "Not(In(source_id"):
        assert filtered in plan, filtered
    by_month = plan_of(w.series.sightings_by_month)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ReadSchema: struct<survey_id:bigint,species_id:int,individual_count:int>" in by_month


def scans(plan: str, table: str) -> int:
    """How often a plan reads the files of a table (the formatted plan lists each scan once)."""
    return len([line for line in plan.splitlines() if line.startswith("Location:") and f"/{table}]" in line])


def formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_outlines_are_read_at_most_three_times(stored, no_broadcast):
    w = workload(stored)
    assert 0 < scans(formatted(w.series.places), "site_vertex") <= 3
    assert 0 < scans(formatted(w.series.sites_in_ranges), "range_vertex") <= 3
    assert scans(formatted(w.series.centroids), "site_vertex") == 2


def test_raw_rows_of_a_profile_are_read_once(stored, no_broadcast):
    w = workload(stored)
    plan = formatted(w.linked_profile)
    assert [scans(plan, t) for t in ("t2_sighting", "t2_taxon_sighting", "t2_survey")] == [1, 1, 1]
    assert scans(formatted(w.direct_profile), "t1_sighting") == 1 and "Expand" not in plan


def test_stored_layers_are_read_where_they_lie(stored, layered, no_broadcast):
    w = workload(layered)
    plan = formatted(w.series.surveys_by_month)
    assert scans(plan, "site_vertex") == scans(plan, "range_vertex") == 0
    # the sites at places are wanted twice; a workload that keeps stages reads their cells once
    assert scans(plan, "plan_layer_site_vertex_cells") == 2 and scans(plan, "plan_layer_taxon_range_cells") == 1
    # only the points are shuffled by cell, not the layer
    assert plan_of(w.series.places).count("Exchange hashpartitioning(level") == 1
    assert plan_of(w.series.sites_in_ranges).count("Exchange hashpartitioning(level") == 1
    assert plan_of(workload(stored).series.places).count("Exchange hashpartitioning(level") == 2


@pytest.mark.parametrize(
    "name", ["sites_in_ranges", "sites_in_ranges_outlines", "surveys_by_month", "all_zero_series", "prior_sites_attributed", "wide_reporting_rate_filled"]
)
def test_stored_layers_give_the_same_rows(stored, layered, name):
    a, b = (sorted(map(str, catalog.run_on(name, tables).collect())) for tables in (stored, layered))
    assert a == b and a


def test_a_stored_layer_is_opened_again(spark, stored, layered, no_broadcast):
    folder = stored.directory
    spark.sql("DROP TABLE plan_layer_site_vertex_cells")  # the files stay: the table is external
    again = open_layer(stored.site_vertex, ["site_id"], "plan_layer_site_vertex", folder, 8)
    points = stored.survey_point.select("x", "y").distinct()
    a, b = (sorted(map(tuple, geo.points_in_polygons(points, v, ["site_id"]).collect())) for v in (again, stored.site_vertex))
    assert a == b
    assert plan_of(geo.points_in_polygons(points, again, ["site_id"])).count("Exchange hashpartitioning(level") == 1


@pytest.mark.parametrize("name", ["method_profile_direct", "method_profile_linked", "method_profiles_appended", "response_variable_classified"])
def test_profiles_multiply_their_rows_over_many_tasks(spark, stored, no_broadcast, name):
    """The rows that hold five values each are dealt to a fixed number of tasks, which no merging of small ones undoes."""
    plan = plan_of(catalog.QUERIES[name](workload(stored)))
    dealt = [line for line in plan.splitlines() if "hashpartitioning(survey_id" in line]
    assert dealt and all(f", {methods.SPREAD})" in line and "REPARTITION_BY_NUM" in line for line in dealt), plan


def test_sightings_are_not_shuffled_once_they_are_repeated(stored, no_broadcast):
    """The sites of a species meet the places first; the last join repeats a sighting, and nothing sorts it out after that."""
    w = workload(stored)
    for frame in (w.series.sightings_in_sites("line"), catalog.QUERIES["sightings_in_sites"](w)):
        lines = plan_of(frame).splitlines()
        last = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        assert all(key in lines[last].split("], [")[0] for key in ("x#", "y#", "site_type#", "sp_id#")) and "Inner" in lines[last], lines[last]
        assert not any("Exchange" in line for line in lines[:last])


@pytest.mark.parametrize("name", ["data_by_year", "data_by_month", "sightings_by_month"])
def test_months_go_to_their_sites_as_one_row(stored, no_broadcast, name):
    plan = plan_of(catalog.QUERIES[name](workload(stored)))
    by_site = [line for line in plan.splitlines() if "Exchange hashpartitioning(site_id" in line and "sp_id" in line]
    assert any("REPARTITION_BY_COL" in line for line in by_site) and "collect_list" in plan, by_site
    assert not any("hashpartitioning(year" in line and "site_type" in line and "sp_id" in line for line in plan.splitlines())


def test_rows_of_a_profile_are_told_apart_where_their_sites_meet(stored, no_broadcast):
    plan = plan_of(catalog.QUERIES["method_profiles_appended"](workload(stored)))
    salted = [line for line in plan.splitlines() if "Exchange" in line and "salt#" in line]
    assert len(salted) == 2 and all("REPARTITION_BY_NUM" in line for line in salted), salted
