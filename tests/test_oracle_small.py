"""Every registered query with an oracle agrees with DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = ["part", "lineitem", "orders", "nation", "region", "customer", "supplier", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
CHEAP = [k for k in E.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = sorted(tuple(_norm(x) for x in r) for r in df.select(sorted(df.columns)).collect())
    res = con.execute(f"SELECT * FROM ({E.oracle_sql()[name]}) q")
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(_norm(r[i]) for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["node_id", "node_name", "cl", "cl_top", "flow"]
    assert df.count() == 200
