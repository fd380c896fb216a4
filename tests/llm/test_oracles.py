"""Queries with SQL, side by side at the smallest size."""

import os

import duckdb
import pytest

from poiforge.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}{'/*.parquet' if os.path.isdir(f'{SF}/{f}') else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got, want = registry.queries()[name](spark, SF), db.sql(registry.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    at = [want.columns.index(c) for c in order]
    assert sorted(str(tuple(r[c] for c in order)) for r in got.collect()) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())
