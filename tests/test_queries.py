"""Every registered query against its SQL in DuckDB, whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from brambling import plans
from tests.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, connection, ORACLES[name]) == ""


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["weekday", "revenue"] and 0 < df.count() <= 7
