"""Each catalogue query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from rallyframe.plans.catalogue import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())
