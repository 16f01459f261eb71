"""Every catalog query against its SQL, on whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from fieldloom.plans import catalog
from fieldloom.plans.oracles import ORACLES
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def connection(tables_dir):
    return connect(tables_dir)


def test_each_catalog_query_has_its_sql():
    assert set(catalog.QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, connection, tables_dir, name):
    problems, _ = compare(spark, connection, tables_dir, name)
    assert not problems, "\n".join(problems)


# what only shows in the larger tables: open bounds of a source, absences in number
@pytest.mark.parametrize("name", ["include_in_analysis", "include_in_analysis_two_rows", "implied_absences"])
def test_query_equals_sql_on_larger_tables(spark, tables_dir, name):
    larger = Path(tables_dir).parent / "sf0.01"
    if not larger.exists():
        pytest.skip("no larger tables")
    problems, rows = compare(spark, connect(str(larger)), str(larger), name)
    assert not problems, "\n".join(problems)
    assert rows > 10_000


def test_entry_yields_rows(spark):
    assert contract.entry(spark).count() > 0
