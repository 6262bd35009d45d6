import datetime as dt

from pyspark.sql import functions as F

from fleetmart.functions import domain
from fleetmart.operators import quality
from fleetmart.operators.joins import is_small, lookup_join, scanned_bytes
from fleetmart.plans import facts, marts, rules, timeline
from registry.core import Data, now

SF = "/root/testdata/sf0.001"


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_size_check_decides_the_join(spark, plan, no_broadcast):
    d = Data(spark, SF)
    assert not is_small(d.zones) and scanned_bytes(d.table("zones")) > 0
    out = lookup_join(d.table("rides"), d.zones.select("zone_id", "city"), "pickup_zone_id", "zone_id", "ride_id")
    assert "SortMergeJoin" in plan(out) and "BroadcastHashJoin" not in plan(out)


def test_facts_and_marts_do_not_depend_on_the_join_strategy(spark, request, plan):
    d = Data(spark, SF)
    small = d.rides.select("ride_id", "driver_key", "passenger_key", "zone_key", "pickup_city", "dropoff_zone_code", "fare_tier").cache()
    small.count()
    request.getfixturevalue("no_broadcast")
    large = Data(spark, SF)
    assert "BroadcastHashJoin" not in plan(large.rides)
    assert same(small, large.rides.select(*small.columns))
    small.unpersist()


def test_null_keys_are_spread_and_match_nothing(spark, no_broadcast):
    fact = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("D"), F.col("id") % 9)).alias("k"))
    dim = spark.createDataFrame([("D0", 1), ("D3", 2), (None, 99)], "dk string, v int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = lookup_join(fact, dim, "k", "dk", "id")
        assert out.count() == 1000 and out.filter("k IS NULL AND v IS NOT NULL").count() == 0
        assert out.filter("v = 1").count() == 112 and out.filter("k = 'D6' AND v IS NOT NULL").count() == 0
        # Two thirds of the rows have no key; no task holds more than a good share of them.
        held = [r["count"] for r in out.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert len(held) == 4 and max(held) < 300
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_keys_are_split_at_run_time(spark, no_broadcast, plan):
    sizes = {
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        fact = spark.range(0, 100_000, 1, 8).select("id", hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("dk"), F.col("id").alias("v")).union(spark.createDataFrame([("hot", -1)], "dk string, v long"))
        counted = lookup_join(fact, dim, "k", "dk", "id").groupBy("v").agg(F.count("pad").alias("n"))
        rows = {r.v: r.n for r in counted.collect()}
        assert rows[-1] == 33_334 and sum(rows.values()) == 100_000
        assert "skew=true" in plan(counted)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_ride_scan_reads_only_what_a_mart_needs(spark, plan):
    text = plan(marts.mart_zone_heatmap(Data(spark, SF).rides))
    lineitem = [line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert lineitem and all("l_extendedprice" not in line for line in lineitem)


def test_marts_aggregate_before_the_shuffle(spark, plan):
    text = plan(marts.mart_daily_ride_summary(Data(spark, SF).rides)).split("== Physical Plan ==")[-1]
    assert "partial_count" in text


def ride_rows(spark, rows):
    return spark.createDataFrame(
        rows, "driver_id string, driver_name string, vehicle_type_code string, vehicle_category string, driver_tier string, requested_date date, "
        "ride_status string, pickup_zone_code string, total_fare decimal(10,2), distance_km decimal(8,2), duration_minutes long, is_surge boolean, "
        "surge_multiplier decimal(4,2), passenger_rating decimal(3,1)",
    )


def test_daily_activity_top_zone_ties_and_nulls(spark):
    from decimal import Decimal as D

    day = dt.date(2026, 1, 1)
    row = lambda zone, status="COMPLETED", drv="d": (drv, "n", "M", "c", "Gold", day, status, zone, D("10.00"), D("1.00"), 5, True, D("2.00"), D("4.0"))
    out = {r.driver_id: r for r in marts.mart_driver_daily_activity(ride_rows(spark, [
        row("B"), row("A"), row("C", "CANCELLED"), row(None, drv="e"), row(None, drv="e"), row("Z", drv="e"), row(None, drv="f"), row("Z", drv="f"), row("A", "CANCELLED", "g"),
    ])).collect()}
    assert out["d"].primary_zone_code == "A" and out["d"].daily_gmv_idr == 20.0 and out["d"].surge_bonus_idr == 10.0
    assert out["e"].primary_zone_code is None and out["f"].primary_zone_code == "Z"
    assert out["g"].daily_gmv_idr == 0.0 and out["g"].avg_fare_idr is None and out["g"].daily_cancelled == 1


def test_incremental_fact_equals_its_slice_of_the_full_one(spark):
    d = Data(spark, SF)
    part = facts.fct_rides(d.table("rides"), d.drivers, d.passengers, d.zones, d.vehicle_types, now("2000-01-01 00:00:00"), 30)
    full = d.rides.filter(F.col("updated_at") >= F.lit("1999-12-02").cast("timestamp"))
    assert same(part.select("ride_key", "total_fare"), full.select("ride_key", "total_fare"))


def stamps(*minutes):
    return [None if m is None else dt.datetime(2026, 1, 1, 8, 0) + dt.timedelta(minutes=m) for m in minutes]


def test_status_durations_case(spark):
    log = spark.createDataFrame([("T", i, t) for i, t in enumerate(stamps(0, 2, 18, 20, 55))], "trip string, n int, ts timestamp")
    got = [r.minutes_to_next for r in timeline.status_durations(log, "trip", "ts", "n").orderBy("n").collect()]
    assert got == [2, 16, 2, 35, None]


def test_cancel_patterns(spark):
    cases = {"no_show": (0, 2, 10, 14), "early_cancel": (0, 2, None, 4), "long_wait_cancel": (0, 2, None, 20), "normal_cancel": (0, 2, None, 12), None: (0, 2, 3, None)}
    events = []
    for name, (req, acc, arr, can) in cases.items():
        for code, at in zip(("requested", "driver_accepted", "driver_arrived", "cancelled"), stamps(req, acc, arr, can)):
            if at:
                events.append((str(name), code, at))
    out = timeline.fct_trip_status_timeline(spark.createDataFrame(events, "trip_id string, status_code string, event_ts timestamp"))
    assert {r.trip_id: r.cancel_pattern for r in out.collect()} == {str(k): k for k in cases}


def test_transition_legality(spark):
    steps = [("a", ["REQUESTED", "ACCEPTED", "PICKED_UP", "COMPLETED"]), ("b", ["REQUESTED", "PICKED_UP"]), ("c", ["REQUESTED", "NO_DRIVER", "ACCEPTED"])]
    rows = [(r, i, s, dt.datetime(2026, 1, 1 + i)) for r, ss in steps for i, s in enumerate(ss)]
    log = spark.createDataFrame(rows, "ride_id string, event_id int, status string, ts timestamp")
    bad = {(r.ride_id, r.previous_status, r.status) for r in quality.dq_transition_legality(log).collect()}
    assert bad == {("b", "REQUESTED", "PICKED_UP"), ("c", "NO_DRIVER", "ACCEPTED")}


def test_freshness_states(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "at timestamp")
    state = lambda hours, frame=df: quality.dq_freshness(frame, "t", "at", F.lit(dt.datetime(2026, 1, 1) + dt.timedelta(hours=hours))).first().status
    assert [state(2), state(3), state(7), state(1, df.limit(0))] == ["pass", "warn", "error", "error"]


def test_report_counts_nulls_as_the_single_checks_do(spark):
    df = spark.createDataFrame([("A", 1, None), ("X", -1, None), (None, None, None), ("A", 5, None)], "s string, v int, e int")
    report = quality.dq_report(df, "t", [quality.not_null("s"), quality.accepted_values("s", ["A"]), quality.accepted_range("v", 0, 4)], ["s", "v", "e"])
    assert {(r.check_name, r.column_name): r.failing for r in report.collect()} == {
        ("not_null", "s"): 1, ("accepted_values", "s"): 1, ("accepted_range", "v"): 2, ("unique", "s"): 1, ("unique", "v"): 0, ("unique", "e"): 0,
    }
    assert quality.dq_accepted_values(df, "s", ["A"]).count() == 1 and quality.dq_accepted_range(df, "v", 0, 4).count() == 2


def test_fare_floor_and_missing_inputs(spark):
    rides = spark.sql("SELECT * FROM VALUES ('a', 1, 1.00, 1L, 1.00, 0.00, 7000.00), ('b', 1, NULL, 1L, 1.00, 0.00, 1.00) AS t(ride_id, vehicle_type_id, distance_km, duration_minutes, surge_multiplier, promo_discount, total_fare)")
    types = spark.sql("SELECT 1 vehicle_type_id, 4000.00 base_fare, 1500.00 per_km_rate, 200.00 per_minute_rate")
    out = {r.ride_id: r for r in rules.recompute_fare(rides, types).collect()}
    assert float(out["a"].expected_fare) == 7000.0 and float(out["a"].difference) == 0.0 and out["b"].expected_fare is None


def test_sequence_numbers_ignore_other_codes(spark):
    codes = spark.createDataFrame([("RIDE-20260101-000042",), ("RIDE-20260101-99",), ("X",), (None,)], "ride_code string")
    assert rules.max_ride_sequence(codes).first()[0] == 42
    assert rules.max_ride_sequence(codes.limit(0)).first()[0] == 0


def test_label_cost(spark):
    jobs = spark.sql("SELECT 10L total_bytes_billed, array(named_struct('key','table','value','rides'), named_struct('key','env','value','dev')) labels UNION ALL SELECT 5L, array(named_struct('key','table','value','rides'))")
    assert [tuple(r) for r in marts.label_cost_rollup(jobs, "table").collect()] == [("rides", 15, 2)]


def test_status_lists():
    assert set(domain.TERMINAL_STATUSES) < set(domain.RIDE_STATUSES)


def test_lookup_compares_keys_alike_at_every_size(spark, no_broadcast):
    """The same rows match whether the dimension counts as small or as large."""
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (0, "zero")], "dk long, v string")
    for kind, keys in {"decimal(10,2)": ["1.00", "2.50", None, "0"], "double": ["1", "-0.0", None, "2"], "int": ["1", "2", None, "7"], "string": ["1", "02", None, "0"]}.items():
        fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string").withColumn("k", F.col("k").cast(kind))
        found = {}
        for limit in ("1g", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found[limit] = {r.id: r.v for r in lookup_join(fact, dim, "k", "dk", "id").collect()}
        assert found["1g"] == found["-1"] and found["-1"][0] == "one" and found["-1"][2] is None, kind


def test_event_fact_joins_the_rides_only(spark):
    plan_text = Data(spark, "/root/testdata/sf0.001").ride_events._jdf.queryExecution().optimizedPlan().toString()
    # Rides come from orders, their items, the customer's zone and the fare table; their context adds one join.
    assert plan_text.count("Join ") <= 6
