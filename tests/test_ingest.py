import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import ingest
from fleetmart.operators.dedup import latest_per_key
from fleetmart.sources.contracts import SPECS, TableSpec

SMALL = "id INT64!, name STRING, flag BOOL, amount NUMERIC, doc STRING, at TIMESTAMP!, changed_at TIMESTAMP"


def spec(**over):
    args = dict(name="t", key="id", declared=SMALL, window_col="at", partition_col="at", order_cols=("changed_at",), json_cols=("doc",))
    return TableSpec(**{**args, **over})


def test_contract_is_checked_when_declared():
    with pytest.raises(ValueError, match="not declared"):
        spec(key="nope")
    with pytest.raises(ValueError, match="partition type"):
        spec(partition_type="HOUR")
    with pytest.raises(ValueError, match="cluster"):
        spec(cluster_cols=("id", "name", "flag", "amount", "at"))
    assert set(SPECS) == {
        "zones", "vehicle_types", "drivers", "passengers", "rides", "ride_events", "payment_methods", "payments", "promotions", "promo_usage",
        "driver_incentives",
    }


def test_unknown_column_is_refused_before_any_work():
    assert ingest.parse_columns(" id,\n\n name ,", spec().types) == ["id", "name"]
    with pytest.raises(ValueError, match="nmae"):
        ingest.parse_columns("id, nmae", spec().types)


def test_cast_to_contract(spark):
    raw = spark.sql("SELECT '7' id, 1 name, 1 flag, 2.5 amount, named_struct('k', 1) doc, timestamp_ntz'2026-01-01 07:00:00' at, timestamp'2026-01-01 00:00:00' changed_at")
    row = ingest.cast_to_contract(raw, spec()).first()
    assert (row.id, row.name, row.flag, float(row.amount), row.doc) == (7, "1", True, 2.5, '{"k":1}')
    # The naive value is local time of the source; the one with a zone keeps its instant.
    assert row.at == row.changed_at == dt.datetime(2026, 1, 1)


def test_window_is_half_open_and_reaches_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "w")
    spark.sql("SELECT id, timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, id) at, 'x' pad FROM range(24)").write.parquet(path)
    df = spark.read.parquet(path)
    out = ingest.window_filter(df, "at", "2025-12-31T20:00:00", "2025-12-31T22:00:00").select("id")
    assert sorted(r.id for r in out.collect()) == [3, 4]
    assert "GreaterThanOrEqual(at" in plan(out) and "pad" not in plan(out).split("ReadSchema")[-1]
    override = ingest.window_filter(df, "at", "2025-12-31T20:00:00", "2025-12-31T22:00:00", window_start="2026-01-01 04:00:00")
    assert [r.id for r in override.collect()] == [4]


def test_latest_per_key_limits_rows_before_the_shuffle(spark, plan):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit(1).alias("o"))
    out = latest_per_key(rows, ["k"], ["o"])
    assert {(r.k, r.v) for r in out.collect()} == {(0, 999), (1, 997), (2, 998)}
    text = plan(out)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def batch(spark, rows):
    return spark.createDataFrame(
        [(i, n, True, "1.0", "{}", dt.datetime(2026, 1, 1, h), dt.datetime(2026, 1, 1, c)) for i, n, h, c in rows],
        "id int, name string, flag boolean, amount string, doc string, at timestamp, changed_at timestamp",
    )


def names(df):
    return {r.id: r.name for r in df.select("id", "name").collect()}


def run(spark, table_spec, rows, target):
    return ingest.ingest_table(table_spec, batch(spark, rows), target, "2026-01-01T00:00:00", "2026-01-02T00:00:00", F.lit("2026-02-01").cast("timestamp"), "UTC")


def test_separate_recency_updates_rows_whose_partition_column_never_moves(spark):
    first, second = [(1, "old", 5, 5)], [(1, "new", 5, 9)]
    good = run(spark, spec(), second, run(spark, spec(), first, None))
    assert names(good) == {1: "new"}
    older = spec().single_recency_column()
    stuck = run(spark, older, second, run(spark, older, first, None))
    assert names(stuck) == {1: "old"}


def test_replaying_and_splitting_a_batch_gives_the_same_state(spark):
    rows = [(1, "a", 1, 1), (1, "b", 1, 3), (2, "c", 2, 2), (1, "late", 1, 2)]
    whole = run(spark, spec(), rows, None)
    assert names(run(spark, spec(), rows, whole)) == names(whole) == {1: "b", 2: "c"}
    split = run(spark, spec(), rows[2:], run(spark, spec(), rows[:2], None))
    assert names(split) == names(whole)


def test_append_only_ignores_known_keys(spark):
    log = spec(append_only=True)
    out = run(spark, log, [(1, "changed", 1, 9), (2, "x", 1, 1)], run(spark, log, [(1, "kept", 1, 1)], None))
    assert names(out) == {1: "kept", 2: "x"}


def test_required_violations(spark):
    df = batch(spark, [(1, "a", 1, 1)]).withColumn("at", F.lit(None).cast("timestamp"))
    assert ingest.required_violations(df, spec()).count() == 1
