"""Registered queries against their SQL on the same tables."""

import pytest

import __spark_entry__ as spark_entry
from check_oracle import check, connect
from conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_statement_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    result, rows, _ = check(spark, con, SF, name)
    assert result == "ok"
    assert rows > 0
