"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from mereweave import plans

SF = "/root/testdata/sf0.001"
REGISTRY = plans.load()


def canon(x):
    if isinstance(x, bool) or x is None or isinstance(x, (int, str)):
        return x
    x = float(x)
    return "nan" if math.isnan(x) else round(x, 6)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(REGISTRY.ORACLES))
def test_oracle(spark, duck, name):
    df = REGISTRY.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(map(canon, r))) for r in df.select(*columns).collect())
    found = duck.execute(REGISTRY.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(canon(r[names.index(c)]) for c in columns)) for r in found.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(REGISTRY.QUERIES) - set(REGISTRY.ORACLES)))
def test_runs(spark, name):
    assert REGISTRY.QUERIES[name](spark, SF).count() >= 0
