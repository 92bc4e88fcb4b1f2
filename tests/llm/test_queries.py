"""The operators' queries against their SQL, whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from brambling.llm import queries
from tests.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(queries.QUERIES) | {"pipeline"}
    assert names <= set(entry.queries()) and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), queries.ORACLES[name]) == ""
