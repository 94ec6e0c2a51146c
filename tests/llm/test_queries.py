"""Registered corpus queries with SQL, against DuckDB over the same files."""

import duckdb
import pytest

from fragmill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_is_as_its_sql(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in got.collect()) == sorted(repr([r[i] for i in at]) for r in want.fetchall())
