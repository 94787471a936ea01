"""Every registered engine query against its SQL, on the driver's smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_registration(spark):
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).columns == ["property", "depth_idx", "y", "x", "value"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    got = QUERIES[name](spark, FOLDER)
    rows = sorted(map(repr, (tuple(r[c] for c in sorted(got.columns)) for r in got.collect())))
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    want = sorted(map(repr, (tuple(r[i] for i in order) for r in cur.fetchall())))
    assert sorted(got.columns) == sorted(columns)
    assert rows == want


def test_source_windows_of_many_suppliers(spark, tmp_path):
    """Keys whose windows lie beyond the product's own grid: below its last row from 5399, past its last column from 22886."""
    con, path = duckdb.connect(), f"{tmp_path}/supplier.parquet"
    keys = "(0), (5398), (5399), (5400), (22885), (22886), (59999), (3000000000)"
    con.execute(f"copy (select k::bigint as s_suppkey from (values {keys}) t(k)) to '{path}' (format parquet)")
    con.execute(f"create view supplier as select * from '{path}'")
    cur = con.execute(SQL["f07_source_window"])
    columns, want = [d[0] for d in cur.description], sorted(cur.fetchall())
    got = QUERIES["f07_source_window"](spark, str(tmp_path))
    assert got.columns == columns and sorted(map(tuple, got.collect())) == want and len(want) == 8
