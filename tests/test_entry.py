"""Driver contract: entry(), and every registered query against its DuckDB
oracle on the smallest test tables."""

import math
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from petalframe.sources.io import TABLES

SF = "/root/testdata/sf0.001"
HAVE_DATA = os.path.isdir(SF)


def _norm(v):
    import pandas as pd

    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = float(f"{v:.9g}") + 0.0
        return int(v) if v.is_integer() else v
    if hasattr(v, "isoformat"):
        return None if pd.isna(v) else pd.Timestamp(v).isoformat()
    if isinstance(v, bool):
        return int(v)
    if v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted(repr(tuple(_norm(x) for x in r)) for r in pdf[cols].itertuples(index=False))


@pytest.mark.skipif(not HAVE_DATA, reason="test tables not present")
def test_entry(spark):
    df = entry(spark)
    assert {"event_id", "user_id", "ts", "purchase_value", "purchase_ts"} <= set(df.columns)
    assert df.count() >= 0


def test_registry_consistent():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert all(fn.__doc__ for fn in q.values())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not HAVE_DATA, reason="test tables not present")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
