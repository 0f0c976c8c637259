"""Driver contract: entry runs, every query has a name, oracles match at the smallest scale factor."""

import math

import duckdb
import pandas as pd
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

TABLES = ["events", "orders", "lineitem"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "label_up" in df.columns


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = set(q) - set(E._llm()[0])
    assert own <= set(o)


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    return v.item() if hasattr(v, "item") else v


def _canon(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=str)


FAST = ["hourly_bars", "bars_15min", "daily_bars_large", "indicators", "indicators_blocked", "time_frames_keyed",
        "labels_horizon_3", "feature_dataset", "daily_proxy", "null_policy", "time_split_counts", "csv_candles",
        "block_files_hourly", "block_files_hourly_stream"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_matches_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    s = _canon(E.queries()[name](spark, SF_SMALL).toPandas())
    d = _canon(con.execute(E.oracle_sql()[name]).fetchdf())
    assert s[0] == d[0]
    assert s[1] == d[1]
