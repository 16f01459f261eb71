from __future__ import annotations

import pytest

EXTRA = "body string, nid long, n int, rank int, key string, spans string, h long, s string, u long, place int, kept boolean"
COLUMNS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
LONG = " ".join(f"w{i % 7001} token{i % 13}" for i in range(20_000))
PLAIN = "The quick brown fox jumps over the lazy dog and then it runs home again to sleep for a while"


def row(key, text):
    return (key, text, "en", "src0", len(text or ""), "x", 1, 2, 3, "k", "s", 4, "s", 5, 6, True)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows."""
    return [
        (7, PLAIN), (3, PLAIN.replace(" ", "\n ")), (9, None), (11, ""), (12, "   "), (13, LONG), (13, LONG), (14, LONG + " end"),
        (None, PLAIN + " tomorrow"), (None, None), (20, "x"), (21, "é" * 300), (22, "é" * 300), (23, "\x00 a" * 80),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame([row(*r) for r in odd_rows], COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def table(spark, tables_dir):
    return spark.read.parquet(f"{tables_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def table_rows(table):
    return [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
