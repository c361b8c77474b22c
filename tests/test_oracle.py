"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from flowtables.suite import QUERIES, SQL
from tests.checking import compare, connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connection(FOLDER) as opened:
        yield opened


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["o_orderkey", "key", "value", "cleared"]
    assert result.count() > 0
