"""Run a catalog query and its SQL and compare the rows as multisets.

As a script: ``python -m tests.compare <directory> [query ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from fieldloom.plans import catalog
from fieldloom.plans.oracles import ORACLES, compose


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(directory).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _kind(name: str) -> str:
    kinds = {
        "bigint": "int64", "int": "int32", "integer": "int32", "smallint": "int16", "double": "double",
        "string": "text", "varchar": "text", "boolean": "bool", "bool": "bool", "date": "date",
    }
    return kinds.get(str(name).lower(), str(name).lower())


def _plain(value: object) -> object:
    # minus zero counts as zero
    return 0.0 if isinstance(value, float) and value == 0 else value


def compare(spark, connection, directory: str, name: str) -> tuple[list[str], int]:
    """Differences found (none when equal) and the number of rows."""
    df = catalog.run(name, spark, directory)
    cursor = connection.execute(compose(name))
    expected_types = {d[0]: _kind(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    got_types = {n: _kind(t) for n, t in df.dtypes}
    problems = []
    if got_types != expected_types:
        problems.append(f"schema: {sorted(set(got_types.items()) ^ set(expected_types.items()))}")
        if set(got_types) != set(expected_types):
            return problems, len(expected)
    order = [list(expected_types).index(c) for c in df.columns]
    want = Counter(tuple(_plain(row[i]) for i in order) for row in expected)
    have = Counter(tuple(_plain(v) for v in row) for row in df.collect())
    if want != have:
        problems.append(f"only SQL ({sum((want - have).values())}): {list((want - have).items())[:3]}")
        problems.append(f"only Spark ({sum((have - want).values())}): {list((have - want).items())[:3]}")
    return problems, len(expected)


def main() -> None:
    from fieldloom.session import build_session

    directory, *names = sys.argv[1:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    failed = 0
    for name in names or ORACLES:
        start = time.time()
        try:
            problems, rows = compare(spark, connection, directory, name)
        except Exception as error:  # a broken query is a finding like any other
            problems, rows = [f"{type(error).__name__}: {str(error)[:1200]}"], -1
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={rows} {time.time() - start:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem[:1500])
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
