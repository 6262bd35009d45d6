"""A spread of registered queries against their SQL at the smallest scale; ``check.py`` runs all of them."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, norm
from registry import load

SF = "/root/testdata/sf0.001"
SPREAD = [
    "dim_drivers", "fct_rides", "fct_ride_events", "mart_daily_ride_summary", "mart_driver_performance", "mart_driver_daily_activity", "ride_funnel",
    "latest_per_key", "merge_if_newer", "scd2_snapshot", "scd2_from_changes", "cdc_apply", "fct_trip_status_timeline", "dm_finance_daily_city",
    "dq_report", "recompute_fare", "merge_table", "stream_apply", "ping_downsample",
]


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    queries, oracles = load()
    assert set(queries) == set(oracles)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", SPREAD)
def test_query_equals_sql(spark, database, name):
    df = entry_points.queries()[name](spark, SF)
    cur = database.execute(entry_points.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    ours = sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=str)
    theirs = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in cur.fetchall()), key=str)
    assert ours == theirs and ours


@pytest.mark.parametrize("name", ["code_exists", "max_ride_sequence"])
def test_seven_digit_keys_equal_sql(spark, tmp_path, name):
    con = duckdb.connect()
    for table in Path(SF).glob("*.parquet"):
        key = {"orders": "o_orderkey", "lineitem": "l_orderkey"}.get(table.stem)
        longer = f" REPLACE (({key} + CASE WHEN {key} % 2 = 0 THEN 1000000 ELSE 0 END)::BIGINT AS {key})" if key else ""
        con.execute(f"COPY (SELECT *{longer} FROM '{table}') TO '{tmp_path}/{table.name}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{tmp_path}/{table.name}'")
    ours = entry_points.queries()[name](spark, str(tmp_path)).collect()
    theirs = con.execute(entry_points.oracle_sql()[name]).fetchall()
    assert sorted(map(str, map(tuple, ours))) == sorted(map(str, theirs))
    assert any(len(r[1]) == 20 for r in theirs) if name == "code_exists" else 0 < theirs[0][0] < 1_000_000
