"""Every query against its SQL at the smallest size."""

import os

import duckdb
import pytest

from poiforge import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}{'/*.parquet' if os.path.isdir(f'{SF}/{f}') else ''}'")
    return con


def same(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, db, name):
    got = catalog.queries()[name](spark, SF)
    want = db.sql(catalog.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    rows = sorted(tuple(same(r[c]) for c in order) for r in got.collect())
    at = [want.columns.index(c) for c in order]
    assert rows == sorted(tuple(same(r[i]) for i in at) for r in want.fetchall())
