"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from barscreen.plans.catalog import ORACLES as SQL
from barscreen.plans.catalog import QUERIES
from tools.check import TABLES, rows_of


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, db, name):
    df = QUERIES[name](spark, small)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(columns, cursor.fetchall()) == mine


def test_entry(spark):
    assert entry.entry(spark).columns
