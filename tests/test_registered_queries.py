"""Every registered query with SQL must equal DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from checks.registry import SQL
from checks.verify import compare, database

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


# A hundred rounds of boosting take minutes; test_models saves and loads a small model.
@pytest.mark.parametrize("name", sorted(set(SQL) - {"s7_model_load"}))
def test_equals_sql(spark, con, name):
    good, message = compare(spark, con, FOLDER, name)
    assert good, message


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["region", "date", "precipitation"] and df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
