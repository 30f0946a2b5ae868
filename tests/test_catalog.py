"""Every registered query against plain SQL over the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from pricetide.plans import catalog, reference_sql

FOLDER = "/root/testdata/sf0.001"
TABLES = ["lineitem", "part", "supplier", "events"]
QUERIES = catalog.registered()
SQL = reference_sql.statements()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= entry_points.queries().keys() and SQL.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    rows = QUERIES[name](spark, FOLDER)
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(rows.columns) == sorted(names)
    expected = sorted(str(tuple(map(plain, r))) for r in cursor.fetchall())
    got = sorted(str(tuple(plain(r[c]) for c in names)) for r in rows.collect())
    assert got == expected


def test_flagship_has_rows(spark):
    assert entry_points.entry(spark).count() == 600
