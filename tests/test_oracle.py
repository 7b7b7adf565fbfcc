"""Every registered query next to its SQL, over the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import difference, duck
from checks.oracle import oracle
from checks.queries import queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF), connection, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_the_flagship_query(spark):
    mart = entry_points.entry(spark)
    assert mart.count() == 1381
