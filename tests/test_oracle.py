"""Every registered query against its DuckDB twin on the small fixture (sf0.001)."""

import math
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if v is None or isinstance(v, (int, bool, str)):
        return v
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def _norm(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_canon(r[i]) for i in order) for r in records), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "TotalRevenue" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _norm(df.columns, got) == _norm(cols, want)
