"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences
from tests.conftest import SMALL

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    assert not QUERIES[name](spark, SMALL).isEmpty()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["country_region"] for r in rows} == {"country_A", "country_N", "country_R"}
