"""Every query with SQL against DuckDB over the same files."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from fragmill.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = catalog.oracle_sql()


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6) + 0.0
    return value


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_is_as_its_sql(spark, sf, duck, name):
    got = catalog.queries()[name](spark, sf)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    left = sorted(repr([plain(r[c]) for c in columns]) for r in got.collect())
    right = sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())
    assert left == right


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
