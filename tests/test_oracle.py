"""Every registered query against its SQL, and the others for rows."""

from __future__ import annotations

import pytest
from oracle import compare, database

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_has_rows(connection, name):
    """Two empty results would be equal."""
    assert connection.execute(SQL[name]).fetchmany(1)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert frame.columns and frame.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["category", "total_revenue"]
    assert frame.count() > 0
