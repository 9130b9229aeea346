"""Every registered query with SQL form equals its DuckDB result on sf0.001."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _key(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v.is_integer():
        v = int(v)
    return (1, repr(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_key(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in sorted(f.removesuffix(".parquet") for f in os.listdir(SF_SMALL) if f.endswith(".parquet")):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, con, name):
    ours = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    theirs = _rows(con.execute(E.oracle_sql()[name]).df())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_state", "orders", "customers", "revenue", "avg_order_value"]
    assert df.count() > 0
