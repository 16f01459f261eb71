"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_QUERIES``
(comma list) replaces the headline set, ``BENCH_STORE`` the folder for stored tables
(``spark.checkpoint.dir``, else ``spark-warehouse`` beside this file).

The survey tables are derived from the given tables once and stored as Parquet,
as a deployment would hold them, and the polygon layers that queries join points to are
made ready; these steps are timed as ``load_tables`` and ``load_layers`` and count in the
total.  Each query then runs whole, from the stored tables into a sink that
discards its rows.  Where a sibling folder holds a tenth of the data, it is run first
and listed under ``smaller``: one scale factor says nothing about growth.  It also
warms the code up, so its own figures include compilation.  The stored tables are
removed at the end.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from fieldloom.plans import catalog
from fieldloom.session import CHECKPOINT_DIR, build_session
from fieldloom.sources.star import StarTables, store_layers, store_views

HEADLINE = [
    "taxon_ranges", "simplified_ranges", "sites_in_ranges", "surveys_by_month", "sightings_in_sites",
    "sightings_by_month", "taxon_sightings", "data_by_month", "data_by_year", "all_zero_series",
    "prior_sites_attributed", "value_differs", "qualifying_series_statistics", "wide_reporting_rate",
    "wide_reporting_rate_filled", "time_series_export", "implied_absences", "include_in_analysis",
    "method_profile_direct", "method_profile_linked", "previous_method", "method_report",
]


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def timed(spark: SparkSession, directory: str, names: list[str], store: str) -> dict[str, float]:
    """Seconds by query over one directory of tables."""
    folder = f"{store}/bench-{uuid.uuid4().hex}"
    try:
        start = time.perf_counter()
        tables = store_views(StarTables(spark, directory), folder)
        times = {"load_tables": round(time.perf_counter() - start, 3)}
        start = time.perf_counter()
        tables = store_layers(tables, f"bench_{uuid.uuid4().hex}")
        times["load_layers"] = round(time.perf_counter() - start, 3)
        for name in names:
            start = time.perf_counter()
            catalog.run_on(name, tables).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    finally:
        _remove(spark, folder)
    return times


def _scale(directory: str) -> float | None:
    found = re.search(r"sf([\d.]+)/?$", directory)
    return float(found.group(1)) if found else None


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    beside = Path(__file__).resolve().parent / "spark-warehouse"
    store = os.environ.get("BENCH_STORE") or spark.conf.get(CHECKPOINT_DIR, None) or beside.as_uri()

    smaller = None
    if scale := _scale(directory):
        sibling = re.sub(r"sf[\d.]+/?$", f"sf{scale / 10:g}", directory)
        if Path(sibling).is_dir():
            smaller = {"sf": scale / 10, "queries": timed(spark, sibling, names, store)}
    times = timed(spark, directory, names, store)
    result = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale,
    }
    print(json.dumps(result | ({"smaller": smaller} if smaller else {})))
    spark.stop()


if __name__ == "__main__":
    main()
