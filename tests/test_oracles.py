"""Every query with SQL gives DuckDB's rows on the smallest tables; the others give rows."""

import glob
import math
import os

import duckdb
import pytest

from tidemark.plans import queries as core

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        path = f if os.path.isfile(f) else f"{f}/*.parquet"
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{path}'")
    return c


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, con, name):
    df = core.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in core.ORACLES:
        assert got
        return
    cur = con.execute(core.ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
