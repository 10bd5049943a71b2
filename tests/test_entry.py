"""Driver contract: entry() runs; every query key is well-formed; a sample of
queries equals its SQL oracle (DuckDB) on the smallest scale factor."""
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
SAMPLE = ["m12_hourly_pickups", "m15_daily_pickups_by_borough", "m23_airport_travel_percentiles",
          "m48_results_by_zone", "k5_win_rate_by_day", "m58_weighted_rollups", "m76_monthly_dashboard",
          "c4_payment_code", "j3_spatial_join_backfill", "m49_geography_series"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pickup_hour" in df.columns


def test_keys_and_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 100 and set(o) <= set(q)


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    si = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    di = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    s = sorted(repr(tuple(_norm(r[i]) for i in si)) for r in sdf.collect())
    d = sorted(repr(tuple(_norm(r[i]) for i in di)) for r in rel.fetchall())
    assert s == d
