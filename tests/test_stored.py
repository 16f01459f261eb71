"""Tables replaced, updated and appended to."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldloom.sources import stored
from fieldloom.sources.tables import open_bucketed, save_bucketed

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in OFF}
    for key, value in OFF.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_table_is_replaced_in_one_step(spark, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        stored.read_current(spark, folder)
    first = stored.replace_table(spark.range(5).withColumn("v", F.lit("a")), folder)
    # a new version may be made from the one it replaces
    second = stored.replace_table(stored.read_current(spark, folder).withColumn("v", F.lit("b")), folder)
    assert {r.v for r in first.collect()} == {"a"}  # a reader under way
    assert {r.v for r in second.collect()} == {r.v for r in stored.read_current(spark, folder).collect()} == {"b"}
    assert stored.drop_old_versions(spark, folder) == 1 and stored.read_current(spark, folder).count() == 5
    assert stored.drop_old_versions(spark, folder) == 0


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    stored.replace_table(spark.range(5), folder)
    live = stored.current_version(spark, folder)
    broken = spark.range(0, 100, 1, 8).withColumn("v", F.expr("IF(id = 77, raise_error('half way'), id)"))
    with pytest.raises(Exception, match="half way"):
        stored.replace_table(broken, folder)
    assert stored.current_version(spark, folder) == live and stored.read_current(spark, folder).count() == 5
    stored.drop_old_versions(spark, folder)
    assert [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()] == [live.rsplit("/", 1)[1]]


def files(path: Path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_an_update_rewrites_only_the_partitions_it_changes(spark, tmp_path):
    path = tmp_path / "series"
    base = spark.range(40).selectExpr("CAST(id % 4 AS INT) AS year", "id", "id * 1.5D AS value", "CAST(NULL AS SMALLINT) AS flag")
    base = base.withColumn("year", F.when(F.col("id") != 39, F.col("year")))
    base.write.partitionBy("year").parquet(str(path))
    before = files(path)
    changes = spark.createDataFrame([(0, 1), (4, None), (2, 5), (777, 9), (None, 3)], "id long, flag int")
    assert stored.update_table(spark, str(path), ["year"], ["id"], changes) == [(0,), (2,)]
    after = files(path)
    kept = {f for f in before if "year=1" in f or "year=3" in f or "HIVE_DEFAULT" in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not any("year=0" in f or "year=2" in f for f in set(after) & set(before))
    want = {(r.year, r.id, r.value): {0: 1, 2: 5}.get(r.id) for r in base.collect()}
    assert {(r.year, r.id, r.value): r.flag for r in spark.read.parquet(str(path)).collect()} == want
    # the same changes once more change nothing
    assert stored.update_table(spark, str(path), ["year"], ["id"], changes) == [] and files(path) == after
    # a partition without a name
    assert stored.update_table(spark, str(path), ["year"], ["id"], spark.createDataFrame([(39, 2)], "id long, flag int")) == [(None,)]
    assert spark.read.parquet(str(path)).where("id = 39").first().flag == 2
    assert spark.read.parquet(str(path)).count() == 40


def test_updates_that_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).selectExpr("id", "id % 2 AS p", "'x' AS v").write.partitionBy("p").parquet(path)
    with pytest.raises(stored.DuplicateKey, match="1"):
        stored.update_table(spark, path, ["p"], ["id"], spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string"))
    for wrong in ("w string", "p long"):
        with pytest.raises(ValueError, match=wrong.split()[0]):
            stored.update_table(spark, path, ["p"], ["id"], spark.createDataFrame([], f"id long, {wrong}"))
    assert {r.v for r in spark.read.parquet(path).collect()} == {"x"}


def test_an_update_can_null_and_meet_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, 2, "d")], "p int, k int, v string").write.partitionBy("p").parquet(path)
    changes = spark.createDataFrame([(1, None), (3, "z")], "k int, v string")
    assert stored.update_table(spark, path, ["p"], ["k"], changes) == [(1,)]
    assert rows(spark.read.parquet(path).select("p", "k", "v")) == sorted([(1, 1, None), (1, 1, None), (1, 2, "c"), (2, 2, "d")], key=str)


@pytest.fixture()
def keyed(spark, tmp_path):
    name = f"keyed_{tmp_path.name.replace('-', '_')}"
    base = spark.range(100).selectExpr("id AS a", "CAST(id % 3 AS INT) AS b", "'old' AS v")
    save_bucketed(base, name, ["a"], 8, str(tmp_path / name))
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_a_batch_is_appended_unless_a_key_clashes(spark, keyed):
    new = spark.createDataFrame([(100, 1, "new"), (5, 0, "new"), (6, 1, "new")], "a long, b int, v string")
    assert stored.append_keyed(new, keyed, ["a", "b"], 8).count() == 103
    for clash in ([(5, 0, "x"), (200, 0, "x")], [(300, 0, "x"), (300, 0, "y")]):
        with pytest.raises(stored.DuplicateKey):
            stored.append_keyed(spark.createDataFrame(clash, "a long, b int, v string"), keyed, ["a", "b"], 8)
    empty = spark.createDataFrame([(None, 0, "x"), (None, 0, "x")], "a long, b int, v string")
    with pytest.raises(stored.DuplicateKey, match="no value"):
        stored.append_keyed(empty, keyed, ["a", "b"], 8)
    assert spark.table(keyed).count() == 103
    assert stored.append_keyed(empty, keyed, ["a", "b"], 8, allow_null=True).count() == 105
    with pytest.raises(ValueError, match="bucketed"):
        stored.append_keyed(new, keyed, ["b"], 8)


def test_the_stored_side_of_an_append_is_not_shuffled(spark, keyed, no_broadcast):
    batch = spark.range(1000).repartition(5).selectExpr("id AS a", "CAST(id AS INT) AS b", "'x' AS v")
    assert plan_of(stored.clashing_keys(batch, spark.table(keyed), ["a"])).count("Exchange hashpartitioning(a") == 1
    stored.append_keyed(spark.createDataFrame([(1000, 1, "x")], "a long, b int, v string"), keyed, ["a"], 8)
    # still so after an append, and after the table was made known again
    assert plan_of(stored.clashing_keys(batch, spark.table(keyed), ["a"])).count("Exchange hashpartitioning(a") == 1


def test_a_bucketed_table_is_known_again(spark, tmp_path):
    path = str(tmp_path / "it's")
    save_bucketed(spark.range(50).selectExpr("id AS a", "array(struct(id AS x)) AS s"), "known_again", "a", 4, path)
    before = rows(spark.table("known_again"))
    spark.sql("DROP TABLE known_again")
    assert rows(open_bucketed(spark, "known_again", "a", 4, path)) == before
    spark.sql("DROP TABLE known_again")
