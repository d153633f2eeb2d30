"""Every registered query equals its DuckDB oracle on the smoke data."""

import hashlib
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from arealens.plans.registry import QUERIES

SMOKE = "/root/testdata/sf0.001"
VIEWS = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in VIEWS:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None))
    return cols, len(rows), hashlib.sha1("\n".join(rows).encode()).hexdigest()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    got = entry.queries()[key](spark, SMOKE).toPandas()
    want = duck.execute(entry.oracle_sql()[key]).df()
    assert _digest(got) == _digest(want)
