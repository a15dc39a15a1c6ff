"""Every registered query, against its SQL where there is some."""

import os

import pytest

import __spark_entry__ as entry_points
import plans
from compare import connect, first_difference, spark_rows, spark_types, sql_rows, sql_types
from seriesloom.plans.oracle import all_sql
from seriesloom.plans.queries import all_queries

FOLDER = os.environ.get("SERIESLOOM_TEST_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()
SQL = all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    plans.check(df)
    assert spark_types(df) == sql_types(connection, SQL[name])
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(connection, SQL[name])
    assert names == expected_names
    assert len(rows) == len(expected) > 0
    assert first_difference(rows, expected) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
