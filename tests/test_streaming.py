import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.session import run_dir
from fleetmart.sources import readers
from fleetmart.streaming import apply, landing, throttle

CHANGE = "id string, v string, __source_ts_ms long, __lsn long, __deleted boolean"


def write(spark, rows, schema, name="in", files=3):
    path = run_dir(spark, name)
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return path


def stream(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def test_apply_equals_batch_whatever_the_batches(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(6)}", str(i), rng.randrange(50), i, rng.random() < 0.2) for i in range(120)]
    last = {}
    for k, v, t, lsn, gone in rows:
        if k not in last or (t, lsn) > last[k][:2]:
            last[k] = (t, lsn, v, gone)
    want = {k: v for k, (_, _, v, gone) in last.items() if not gone}
    path = write(spark, rows, CHANGE)
    for files in (1, 10):
        out = run_dir(spark, "applied")
        apply.stream_apply(stream(spark, path, CHANGE, files), out, run_dir(spark, "ck"), ["id"]).awaitTermination()
        assert {r.id: r.v for r in apply.applied_state(spark, out, ["id"]).collect()} == want


def test_apply_resumes_from_its_checkpoint(spark):
    path, out, ck = write(spark, [("a", "1", 1, 1, False)], CHANGE, files=1), run_dir(spark, "applied"), run_dir(spark, "ck")
    apply.stream_apply(stream(spark, path, CHANGE), out, ck, ["id"]).awaitTermination()
    spark.createDataFrame([("a", "2", 2, 2, False)], CHANGE).write.mode("append").parquet(path)
    apply.stream_apply(stream(spark, path, CHANGE), out, ck, ["id"]).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    assert [r.v for r in apply.applied_state(spark, out, ["id"]).collect()] == ["2"]


def test_compaction_keeps_deletes_in_force_and_takes_further_batches(spark):
    path, out, ck = write(spark, [("a", "1", 5, 1, False), ("a", "1", 9, 2, True), ("b", "1", 1, 3, False)], CHANGE), run_dir(spark, "applied"), run_dir(spark, "ck")
    run = lambda: apply.stream_apply(stream(spark, path, CHANGE, 10), out, ck, ["id"]).awaitTermination()
    state = lambda: {r.id: r.v for r in apply.applied_state(spark, out, ["id"]).collect()}
    run()
    apply.compact(spark, out, ["id"])
    assert state() == {"b": "1"}
    for v, t in (("2", 10), ("3", 11)):
        spark.createDataFrame([("a", "old", 7, 4, False), ("b", v, t, t, False)], CHANGE).write.mode("append").parquet(path)
        run()
        assert state() == {"b": v}
        apply.compact(spark, out, ["id"])
        assert state() == {"b": v}
    # A base without its success mark and batches that a base already holds do not count.
    spark.createDataFrame([("c", "x", 99, 99, False)], CHANGE).write.parquet(f"{out}/batch_id=0")
    broken = f"{out}/{apply.BASE}/upto=99"
    spark.createDataFrame([("d", "x", 99, 99, False)], CHANGE).write.parquet(broken)
    apply.remove_path(spark, f"{broken}/_SUCCESS")
    assert state() == {"b": "3"}


def test_landing_folders_follow_local_wall_clock(spark):
    path, out = write(spark, [(1,), (2,)], "x int"), run_dir(spark, "land")
    clock = F.lit("2025-12-31 18:30:00").cast("timestamp")
    landing.stream_land(stream(spark, path, "x int", 5), out, run_dir(spark, "ck"), "cdc.public.rides", clock=clock).awaitTermination()
    row = spark.read.schema("x int, topic string, year string, month string, day string, hour string").parquet(out).drop("x").distinct().collect()
    assert [tuple(r) for r in row] == [("cdc.public.rides", "2026", "01", "01", "01")]


def test_dead_letters_and_strict_mode(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    path = write(spark, [('{"a": 1}',), ('{"a": ',), ('{"a": "x"}',), ('{"a": 4}',)], "value string", files=1)
    good, bad = run_dir(spark, "good"), run_dir(spark, "bad")
    landing.stream_dlq(stream(spark, path, "value string"), schema, good, bad, run_dir(spark, "ck")).awaitTermination()
    assert sorted(r.a for r in spark.read.parquet(good).collect()) == [1, 4]
    assert sorted(r.raw for r in spark.read.parquet(bad).collect()) == ['{"a": ', '{"a": "x"}']
    with pytest.raises(Exception):
        landing.stream_dlq(stream(spark, path, "value string"), schema, run_dir(spark, "g"), run_dir(spark, "b"), run_dir(spark, "ck"), tolerance="none").awaitTermination()


def test_hourly_load_appends_each_file_once(spark):
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    path, out, ck = write(spark, [(1,), (2,)], schema), run_dir(spark, "raw"), run_dir(spark, "ck")
    load = lambda: landing.hourly_incremental_load(spark, path, schema, out, ck)
    load()
    load()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(3,)], schema).write.mode("append").parquet(path)
    load()
    assert spark.read.parquet(out).count() == 3
    assert readers.scan_landing(spark, run_dir(spark, "nothing")) is None


def test_late_rows_beyond_the_limit_are_dropped(spark):
    schema = "id int, ts timestamp"
    path, out, ck = write(spark, [(1, dt.datetime(2026, 1, 10))], schema, files=1), run_dir(spark, "out"), run_dir(spark, "ck")

    def run():
        rows = landing.stream_late_data(stream(spark, path, schema), "ts", ["id"])
        rows.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()

    run()
    spark.createDataFrame([(1, dt.datetime(2026, 1, 10)), (2, dt.datetime(2026, 1, 8)), (3, dt.datetime(2026, 1, 1))], schema).coalesce(1).write.mode("append").parquet(path)
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


def greedy(rows, gap):
    last, kept = {}, set()
    for k, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if k not in last or (t - last[k]).total_seconds() >= gap:
            last[k] = t
            kept.add(i)
    return kept


@pytest.mark.parametrize("seed, gap, slices", [(1, 10, 1), (2, 30, 2), (3, 30, 64), (4, 17, 3), (5, 60, 8)])
def test_thinning_equals_the_sequential_rule(spark, seed, gap, slices):
    rng = random.Random(seed)
    start = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(1500):
        key = None if i % 97 == 0 else ("hot" if rng.random() < 0.5 else f"d{rng.randrange(4)}")
        rows.append((key, start + dt.timedelta(milliseconds=rng.randrange(3_000_000)), i))
    df = spark.createDataFrame(rows, "driver string, at timestamp, n long")
    got = [r.n for r in throttle.ping_downsample(df, "driver", "at", gap, slices).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows, gap)


def test_thinning_leaves_out_pings_without_a_time(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", dt.datetime(2026, 1, 1), 2), ("b", None, 3)], "driver string, at timestamp, n long")
    assert [r.n for r in throttle.ping_downsample(df, "driver", "at", 10).collect()] == [2]
    assert throttle.ping_downsample(df.limit(0), "driver", "at", 10).collect() == []


def test_streamed_thinning_equals_the_rule_and_frees_its_state(spark):
    rng, start, gap = random.Random(6), dt.datetime(2026, 1, 1), 60
    rows = [(rng.choice(["a", "b", "c", None]), start + dt.timedelta(seconds=rng.randrange(20_000)), i, None if i % 7 == 0 else i) for i in range(600)]
    # Batches in order of arrival; a third of the pings come up to 50 minutes late, none later than the limit.
    arrival = {r[2]: r[1] + dt.timedelta(seconds=rng.choice([0, 0, rng.randrange(3000)])) for r in rows}
    schema = "driver string, at timestamp, n long, maybe int"
    path, out, ck = run_dir(spark, "pings"), run_dir(spark, "kept"), run_dir(spark, "ck")
    spark.createDataFrame([], schema).write.parquet(path)
    kept = throttle.stream_ping_downsample(spark.readStream.schema(schema).parquet(path), "driver", "at", gap, "1 hour")
    held = []
    far = [("beat", dt.datetime(2030, 1, 1), -1, None)]
    parts = [[r for r in rows if k * 5000 <= (arrival[r[2]] - start).total_seconds() < (k + 1) * 5000] for k in range(5)]
    for part in [*parts, far, [("beat", dt.datetime(2030, 1, 3), -2, None)], [("a", dt.datetime(2026, 1, 1), 999, None)], [("beat", dt.datetime(2030, 1, 5), -3, None)]]:
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        query = kept.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
        query.awaitTermination()
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    got = {r.n: r for r in spark.read.parquet(out).collect()}
    assert {n for n in got if n >= 0} == greedy([(k, t, i) for k, t, i, _ in rows], gap)
    assert all(got[i].at == t and got[i].maybe == m and got[i].driver == k for k, t, i, m in rows if i in got)
    # What waits and what the gap still needs is held; in the end that is the last heartbeat alone, with its timer.
    assert max(held) >= 8 and held[-1] <= 2


def test_timeline_takes_late_events_and_compacts(spark):
    schema = "trip_id string, event_ts timestamp, status_code string"
    rng, start = random.Random(8), dt.datetime(2026, 1, 1)
    rows = [(f"t{rng.randrange(9)}", start + dt.timedelta(minutes=rng.randrange(10_000)), rng.choice(["requested", "driver_accepted", "completed", "cancelled", "other"])) for _ in range(300)]
    path, out, ck = run_dir(spark, "trips"), run_dir(spark, "timeline"), run_dir(spark, "ck")
    for k in range(3):
        spark.createDataFrame(rows[k * 100 : (k + 1) * 100], schema).coalesce(2).write.mode("append").parquet(path)
        query = apply.stream_trip_timeline(stream(spark, path, schema), out, ck)
        query.awaitTermination()
        assert not query.recentProgress[-1]["stateOperators"]
        for _ in range(2):
            got = {r.trip_id: r.ts_requested for r in apply.current_timeline(spark, out).collect()}
            seen = rows[: (k + 1) * 100]
            assert got == {t: min((ts for x, ts, s in seen if x == t and s == "requested"), default=None) for t, _, _ in seen}
            apply.compact_timeline(spark, out)
        assert spark.read.parquet(f"{out}/{apply.BASE}").count() == len({t for t, _, _ in seen})


def test_minimum_gap():
    assert [throttle.min_gap_seconds(r) for r in (0, 1, 2, 6, 60)] == [60, 60, 30, 10, 10]


def test_topics_are_chosen_by_pattern(spark):
    root, out = run_dir(spark, "topics"), run_dir(spark, "out")
    names = ["cdc.public.rides", "cdc.public.payments", "cdc.ride_ops_mg.ride_events", "xcdc.public.rides"]
    spark.createDataFrame([(i, n) for i, n in enumerate(names)], "x int, topic string").write.partitionBy("topic").parquet(root)
    rows = readers.scan_topic_files(spark, root, T.StructType([T.StructField("x", T.IntegerType())]))
    rows.writeStream.format("parquet").option("checkpointLocation", run_dir(spark, "ck")).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [0, 2]


def test_seed_files_must_match_their_schema(spark):
    path = run_dir(spark, "seed")
    spark.createDataFrame([("a", "x")], "code string, n string").write.option("header", True).csv(path)
    good = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.StringType())])
    assert readers.scan_seed_csv(spark, path, good).count() == 1
    with pytest.raises(Exception):
        readers.scan_seed_csv(spark, path, T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.IntegerType())])).collect()
