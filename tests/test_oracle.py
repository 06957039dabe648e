"""Every catalog query against its DuckDB statement on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

from paths import SF_SMOKE

TABLES = ["events", "lineitem", "orders"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMOKE}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMOKE).toPandas()
    exp = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _rows(got) == _rows(exp)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "moving_avg_7" in df.columns


def test_every_query_has_an_oracle_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
