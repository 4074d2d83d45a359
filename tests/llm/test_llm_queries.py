"""Registered queries whose SQL DuckDB can run, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from checks.verify import compare, database
from rainpanel.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    good, message = compare(spark, database(FOLDER), FOLDER, name, queries.QUERIES, queries.SQL)
    assert good, message


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry_point.queries()) and set(queries.SQL) <= set(entry_point.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
