"""Every registered query with SQL equals that SQL; the others return rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle_connection

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    with oracle_connection(FOLDER) as connection:
        yield connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    result = compare(queries()[name](spark, FOLDER), con, SQL[name])
    assert result.startswith("ok") and not result.startswith("ok 0 "), result


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_query_returns_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
