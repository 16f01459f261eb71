"""Files in, tables out, stages kept."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from fieldloom import session
from fieldloom.plans import catalog
from fieldloom.plans.catalog import Workload
from fieldloom.plans.pipelines import SeriesBuild, stored_under
from fieldloom.sources import tables
from fieldloom.sources.star import StarTables


def test_csv_is_typed(spark, tmp_path):
    path = tmp_path / "focal.csv"
    path.write_text("taxon_id,focal\nu1,1\nu2,1\n")
    df = tables.read_csv(spark, str(path), tables.FOCAL_LIST)
    assert [tuple(r) for r in df.orderBy("taxon_id").collect()] == [("u1", 1), ("u2", 1)]
    assert tables.missing_values(df, tables.FOCAL_LIST).count() == 0


def test_csv_faults_are_found(spark, tmp_path):
    path = tmp_path / "focal.csv"
    path.write_text("taxon_id,focal\nu1,one\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_csv(spark, str(path), tables.FOCAL_LIST).collect()
    path = tmp_path / "gap.csv"
    path.write_text("taxon_id,focal\nu1,1\nu2,\n")
    gaps = tables.missing_values(tables.read_csv(spark, str(path), tables.FOCAL_LIST), tables.FOCAL_LIST)
    assert [r.taxon_id for r in gaps.collect()] == ["u2"]


def test_tables_are_written_and_not_replaced_by_mistake(spark, tmp_path):
    df = spark.range(6).selectExpr("id", "id % 2 AS year")
    path = str(tmp_path / "t")
    assert tables.write_table(df, path, partition_by=["year"]).count() == 6
    with pytest.raises(PySparkException):
        tables.write_table(df, path, mode="errorifexists")
    assert tables.read_table(spark, path).where("year = 1").count() == 3
    assert tables.empty_table(spark, tables.PROCESSING_METHOD).count() == 0


def test_stages_stored_as_tables_give_the_same_series(spark, tables_dir, tmp_path):
    w = Workload(StarTables(spark, tables_dir))
    kept = SeriesBuild(w.series.inputs, catalog.SCOPE, stored_under(str(tmp_path)))
    a = catalog.published(kept.flagged(w.t.processing_method))
    b = catalog.published(w.flagged)
    assert {p.name for p in tmp_path.iterdir()} == {"taxon_ranges", "sites_at_places", "surveys_per_site", "data_by_year"}
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lineage_is_cut_in_the_shared_folder(spark):
    cut = session.cut_lineage(spark.range(10))
    assert cut.count() == 10
    assert "Scan ExistingRDD" in cut._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("folder", ["file:/mnt/shared/9b27", "hdfs://names/shared", "/mnt/shared"])
def test_off_local_mode_any_named_folder_is_taken(folder):
    context = SimpleNamespace(master="spark://driver:7077", getCheckpointDir=lambda: folder)
    assert session.shared_folder(SimpleNamespace(sparkContext=context, conf={})) == folder


def test_off_local_mode_a_folder_must_be_named():
    context = SimpleNamespace(master="spark://driver:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="must name a folder"):
        session.shared_folder(SimpleNamespace(sparkContext=context, conf={}))


def test_stages_are_kept_off_local_mode_in_a_folder_with_a_scheme(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", tmp_path.as_uri)
    assert session.cut_lineage(spark.range(10)).count() == 10
    assert session.shared_folder(spark) == tmp_path.as_uri()


def test_a_repeated_key_is_refused_on_load(spark, tmp_path):
    path = tmp_path / "focal.csv"
    path.write_text("taxon_id,focal\nu1,1\nu1,2\n")
    with pytest.raises(ValueError, match="u1"):
        tables.read_csv(spark, str(path), tables.FOCAL_LIST, unique=["taxon_id"])
    assert tables.read_csv(spark, str(path), tables.FOCAL_LIST).count() == 2
