"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registered
from tests.oracle import difference, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registered.queries()
ORACLES = registered.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert registered.entry(spark).count() > 0
