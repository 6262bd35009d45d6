import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetmart.operators import changes, history, merge, sinks
from fleetmart.operators.sequence import row_slices, with_neighbour
from fleetmart.session import run_dir


def ts(text):
    return F.lit(text).cast("timestamp")


def when(day, hour=0):
    return dt.datetime(2026, 1, day, hour)


def test_evolve_schema_adds_and_refuses(spark):
    target = spark.createDataFrame([(1, "a")], "id int, s string")
    wider = spark.createDataFrame([(1, "a", 2.0)], "id int, s string, x double")
    out, report = merge.evolve_schema(target, wider)
    assert report == "added:x" and out.columns == ["id", "s", "x"]
    assert merge.evolve_schema(out, wider)[1] == "no_changes"
    with pytest.raises(merge.SchemaConflict):
        merge.evolve_schema(target, spark.createDataFrame([("1",)], "id string"))


def test_delete_missing(spark):
    target = spark.range(5)
    assert sorted(r.id for r in merge.merge_delete_missing(target, spark.range(3), ["id"]).collect()) == [0, 1, 2]


def drivers(spark, rows):
    return spark.createDataFrame(rows, "driver_id string, status string, updated_at timestamp")


def versions(df):
    return sorted((r.driver_id, r.status, r.valid_from, r.valid_to) for r in df.collect())


def snap(spark, hist, rows, day, **kw):
    return history.scd2_snapshot(hist, drivers(spark, rows), "driver_id", "updated_at", F.lit(when(day)).cast("timestamp"), **kw)


def test_snapshot_life_of_a_row(spark):
    h = snap(spark, None, [("a", "ACTIVE", when(1)), ("b", "ACTIVE", when(1))], 2)
    h = snap(spark, h, [("a", "SUSPENDED", when(3)), ("b", "ACTIVE", when(1)), ("c", "NEW", when(3))], 4)
    again = snap(spark, h, [("a", "SUSPENDED", when(3)), ("b", "ACTIVE", when(1)), ("c", "NEW", when(3))], 5)
    assert versions(again) == versions(h)
    h = snap(spark, h, [("b", "ACTIVE", when(1)), ("c", "NEW", when(3))], 6)
    h = snap(spark, h, [("a", "BACK", when(7)), ("b", "ACTIVE", when(1)), ("c", "NEW", when(3))], 8)
    got = [v for v in versions(h) if v[0] == "a"]
    assert got == [("a", "ACTIVE", when(1), when(3)), ("a", "BACK", when(7), None), ("a", "SUSPENDED", when(3), when(6))]
    assert history.scd2_current(h).count() == 3
    assert [r.status for r in history.scd2_as_of(h, ts("2026-01-04")).filter("driver_id = 'a'").collect()] == ["SUSPENDED"]
    assert history.scd2_as_of(h, ts("2026-01-06 12:00:00")).filter("driver_id = 'a'").count() == 0
    moved = history.scd2_transitions(h, "driver_id", "status", ts("2026-01-01"), ts("2026-02-01"))
    assert {(r.from_value, r.to_value, r.transitions) for r in moved.collect()} == {("ACTIVE", "SUSPENDED", 1), ("SUSPENDED", "BACK", 1)}
    assert [(r.driver_id, r.changes) for r in history.changed_more_than_once(h, "driver_id", "status").collect()] == [("a", 2)]


def test_snapshot_without_hard_deletes_keeps_the_row_open(spark):
    h = snap(spark, None, [("a", "ACTIVE", when(1))], 2)
    h = snap(spark, h, [("b", "NEW", when(3))], 4, hard_deletes=False)
    assert history.scd2_current(h).count() == 2


def test_snapshots_lose_what_the_change_log_keeps(spark):
    states = [("c", "bronze", 1000), ("u", "silver", 1001), ("u", "gold", 1002), ("u", "platinum", 1003)]
    log = spark.createDataFrame([("C001", op, s, when(15, 9 + i), lsn) for i, (op, s, lsn) in enumerate(states)], "k string, op string, status string, ts timestamp, lsn long")
    full = history.scd2_from_changes(log, "k").orderBy("lsn").collect()
    assert [r.status for r in full] == ["bronze", "silver", "gold", "platinum"]
    assert [r.valid_to for r in full] == [when(15, 10), when(15, 11), when(15, 12), None]
    h = snap(spark, None, [("C001", "bronze", when(15, 9))], 16)
    h = snap(spark, h, [("C001", "platinum", when(15, 12))], 17)
    assert "silver" not in {r.status for r in h.collect()}


def test_change_log_versions_with_ties_and_deletes(spark):
    log = spark.createDataFrame(
        [("k", "c", "a", when(1), 1), ("k", "u", "b", when(2), 2), ("k", "u", "c", when(2), 3), ("k", "d", "c", when(4), 4), ("k", "c", "d", when(6), 5)],
        "k string, op string, status string, ts timestamp, lsn long",
    )
    got = sorted((r.status, r.valid_from, r.valid_to) for r in history.scd2_from_changes(log, "k").collect())
    assert got == [("a", when(1), when(2)), ("c", when(2), when(4)), ("d", when(6), None)]


@pytest.mark.parametrize("previous", [False, True])
def test_neighbour_equals_plain_window_also_for_a_hot_key(spark, previous):
    rng = random.Random(7)
    name = lambda: "hot" if rng.random() < 0.6 else rng.choice([None, "a", "b", "c", "d"])
    rows = [(name(), when(1) + dt.timedelta(minutes=rng.randrange(20000)), i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v long")
    w = Window.partitionBy("k").orderBy("ts", "v")
    plain = df.withColumn("o", (F.lag if previous else F.lead)("v").over(w))
    sliced = with_neighbour(df, ["k"], ["ts", "v"], {"o": "v"}, F.date_trunc("day", "ts"), previous)
    assert sorted(map(tuple, sliced.select("k", "v", "o").collect()), key=str) == sorted(map(tuple, plain.select("k", "v", "o").collect()), key=str)


@pytest.mark.parametrize("previous", [False, True])
def test_row_slices_bound_a_hot_key_within_a_day(spark, previous):
    rng = random.Random(5)
    rows = [("hot", when(3) + dt.timedelta(seconds=rng.randrange(86_000)), i) for i in range(1200)] + [(f"k{rng.randrange(9)}", when(rng.randrange(1, 20)), i) for i in range(800)] + [("hot", None, -1), (None, when(3), -2)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    cut = row_slices(df, "ts", 100)
    sizes = [r.n for r in df.groupBy("k", cut.alias("s")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 250 and len(sizes) > 20
    w = Window.partitionBy("k").orderBy("ts", "v")
    plain = df.withColumn("o", (F.lag if previous else F.lead)("v").over(w))
    sliced = with_neighbour(df, ["k"], ["ts", "v"], {"o": "v"}, cut, previous)
    assert sorted(map(str, sliced.select("k", "v", "o").collect())) == sorted(map(str, plain.select("k", "v", "o").collect()))
    assert df.select(row_slices(df, "ts")).distinct().count() == 1


def test_neighbour_shuffles_the_rows_once(spark, no_broadcast, plan):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.timestamp_seconds(F.col("id") * 999).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    text = plan(with_neighbour(df, ["k"], ["ts"], {"next_ts": "ts"}, F.date_trunc("day", "ts"))).split("== Physical Plan ==")[-1]
    assert "BroadcastHashJoin" not in text
    # The wide rows cross one exchange; the others carry edge rows only.
    assert text.count("Exchange hashpartitioning") <= 4
    window_at = text.index("Window [lead(")
    assert "Exchange" not in text[text.index("SortMergeJoin") : window_at]


def test_high_water_mark_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a timestamp, b timestamp")
    assert history.high_water_mark(empty, ["a", "b"], ts("2026-01-01")).first()[0] == when(1)


def change(spark, rows):
    return spark.createDataFrame(rows, "id string, v string, __source_ts_ms long, __lsn long, __deleted boolean")


def test_cdc_apply_is_idempotent_and_order_free(spark):
    events = [("a", "1", 10, 1, False), ("a", "2", 20, 2, False), ("b", "1", 10, 3, False), ("b", "1", 30, 4, True), ("c", "1", 5, 5, False)]
    state = lambda df: {r.id: r.v for r in df.collect()}
    once = changes.cdc_apply(None, change(spark, events), ["id"], keep_deleted=True)
    assert state(once.filter("NOT __deleted")) == {"a": "2", "c": "1"}
    assert state(changes.cdc_apply(once, change(spark, events[:3]), ["id"])) == {"a": "2", "c": "1"}
    shuffled = changes.cdc_apply(changes.cdc_apply(None, change(spark, events[3:]), ["id"], keep_deleted=True), change(spark, events[:3]), ["id"])
    assert state(shuffled) == {"a": "2", "c": "1"}


def test_unwrap_keeps_or_drops_tombstones(spark):
    env = spark.createDataFrame(
        [("c", 1, None, ("k", "x"), ("db", "t", 1)), ("d", 2, ("k", "x"), None, ("db", "t", 2)), (None, None, None, None, None)],
        "op string, ts_ms long, before struct<id:string,v:string>, after struct<id:string,v:string>, source struct<db:string,table:string,lsn:long>",
    )
    kept = changes.cdc_unwrap(env).collect()
    assert [(r.id, r["__op"], r["__deleted"]) for r in kept] == [("k", "c", False), ("k", "d", True), (None, None, None)]
    assert changes.cdc_unwrap(env, drop_tombstones=True).count() == 2


def rows_of(spark, path):
    return sorted(tuple(r) for r in sinks.read_table(spark, path).select("id", "v", "day").collect())


def test_merge_table_moves_rows_between_partitions_and_drops_emptied_ones(spark):
    path = run_dir(spark, "t")
    make = lambda rows: spark.createDataFrame(rows, "id int, v int, day date")
    sinks.merge_table(spark, path, make([(1, 1, when(1).date()), (2, 1, when(2).date()), (3, 1, when(3).date())]), ["id"], ["v"], "day")
    untouched = {r.f for r in spark.read.parquet(path).filter("id = 3").select(F.input_file_name().alias("f")).collect()}
    moved = make([(1, 2, when(2).date()), (2, 0, when(9).date())])
    for _ in range(2):
        sinks.merge_table(spark, path, moved, ["id"], ["v"], "day")
        assert rows_of(spark, path) == [(1, 2, when(2).date()), (2, 1, when(2).date()), (3, 1, when(3).date())]
    assert not sinks.path_exists(spark, f"{path}/{sinks.PARTITION_COLUMN}=2026-01-01")
    assert {r.f for r in spark.read.parquet(path).filter("id = 3").select(F.input_file_name().alias("f")).collect()} == untouched


def test_merge_table_accepts_new_columns(spark):
    path = run_dir(spark, "t")
    sinks.merge_table(spark, path, spark.createDataFrame([(1, 1, when(1).date()), (5, 1, when(5).date())], "id int, v int, day date"), ["id"], ["v"], "day")
    sinks.merge_table(spark, path, spark.createDataFrame([(1, 2, when(1).date(), "x")], "id int, v int, day date, extra string"), ["id"], ["v"], "day")
    got = {r.id: r.extra for r in sinks.read_table(spark, path).collect()}
    assert got == {1: "x", 5: None}


def test_merge_table_keeps_and_moves_rows_of_the_null_partition(spark):
    path, make = run_dir(spark, "t"), lambda rows: spark.createDataFrame(rows, "id int, v int, day date")
    sinks.merge_table(spark, path, make([(1, 1, None), (2, 1, None), (3, 1, when(3).date())]), ["id"], ["v"], "day")
    sinks.merge_table(spark, path, make([(2, 2, None), (3, 2, when(3).date())]), ["id"], ["v"], "day")
    assert sorted(map(str, rows_of_any(spark, path))) == sorted(map(str, [(1, 1, None), (2, 2, None), (3, 2, when(3).date())]))
    sinks.merge_table(spark, path, make([(1, 3, when(4).date()), (2, 3, when(4).date())]), ["id"], ["v"], "day")
    assert sorted(map(str, rows_of_any(spark, path))) == sorted(map(str, [(1, 3, when(4).date()), (2, 3, when(4).date()), (3, 2, when(3).date())]))
    assert not sinks.path_exists(spark, f"{path}/{sinks.PARTITION_COLUMN}={sinks.NULL_PARTITION}")
    sinks.merge_table(spark, path, make([(9, 1, None)]), ["id"], ["v"], "day")
    assert (9, 1, None) in rows_of_any(spark, path)


def rows_of_any(spark, path):
    return [tuple(r) for r in sinks.read_table(spark, path).select("id", "v", "day").collect()]


def test_merge_table_that_holds_the_null_partition_alone(spark):
    path, make = run_dir(spark, "t"), lambda rows: spark.createDataFrame(rows, "id int, v int, day date")
    for v in (1, 2):
        sinks.merge_table(spark, path, make([(1, v, None)]), ["id"], ["v"], "day")
    assert rows_of_any(spark, path) == [(1, 2, None)]


@pytest.mark.parametrize("fixed", [False, True])
def test_merge_table_survives_a_replacement_that_breaks_off(spark, monkeypatch, fixed):
    path, make = run_dir(spark, "t"), lambda rows: spark.createDataFrame(rows, "id int, v int, day date")
    sinks.merge_table(spark, path, make([(i, 1, when(1 + i % 2).date()) for i in range(5)]), ["id"], ["v"], "day")

    def broken(df, target, partition):
        # The old folder is gone, the new one not yet in its place.
        sinks.remove_path(spark, f"{target}/{partition}=2026-01-01")
        raise RuntimeError("lost")

    source = make([(0, 2, when(1).date()), (7, 1, when(1).date())])
    with monkeypatch.context() as m:
        m.setattr(sinks, "partition_overwrite", broken)
        with pytest.raises(RuntimeError):
            sinks.merge_table(spark, path, source, ["id"], ["v"], "day", partition_fixed=fixed)
    want = [(0, 2, when(1).date())] + [(i, 1, when(1 + i % 2).date()) for i in range(1, 5)] + [(7, 1, when(1).date())]
    sinks.merge_table(spark, path, source, ["id"], ["v"], "day", partition_fixed=fixed)
    assert sorted(rows_of_any(spark, path)) == want
    assert not sinks.path_exists(spark, f"{path}/{sinks.JOURNAL}") and not sinks.finish_merge(spark, path)


def test_merge_table_drops_a_journal_that_never_got_ready(spark, monkeypatch):
    path, make = run_dir(spark, "t"), lambda rows: spark.createDataFrame(rows, "id int, v int, day date")
    sinks.merge_table(spark, path, make([(1, 1, when(1).date())]), ["id"], ["v"], "day")
    make([(1, 9, when(1).date())]).write.parquet(f"{path}/{sinks.JOURNAL}/rows")
    sinks.merge_table(spark, path, make([(2, 1, when(1).date())]), ["id"], ["v"], "day")
    assert sorted(rows_of_any(spark, path)) == [(1, 1, when(1).date()), (2, 1, when(1).date())]


def test_newer_merge_with_nulls_in_the_order_columns(spark):
    make = lambda rows: spark.createDataFrame(rows, "id int, a int, b int, v string")
    target = make([(1, None, 1, "t"), (2, 1, 1, "t"), (3, 1, None, "t"), (4, 1, 1, "t"), (5, None, 1, "t")])
    source = make([(1, 5, 1, "s"), (2, None, 9, "s"), (3, 1, 5, "s"), (4, 1, 2, "s"), (5, None, 2, "s"), (6, None, None, "s")])
    got = {r.id: r.v for r in merge.merge_if_newer(target, source, ["id"], ["a", "b"]).collect()}
    assert got == {1: "t", 2: "t", 3: "t", 4: "s", 5: "s", 6: "s"}


def test_facts_find_the_version_of_their_moment(spark):
    versions = spark.createDataFrame([("a", when(5), when(8), 1), ("a", when(8), None, 2), ("b", when(5), when(6), 3)], "id string, valid_from timestamp, valid_to timestamp, n int")
    rows = spark.createDataFrame([(1, "a", when(1)), (2, "a", when(5)), (3, "a", when(8)), (4, "a", when(9)), (5, "b", when(7)), (6, None, when(7)), (7, "c", when(7)), (8, "b", when(2))], "k int, ref string, at timestamp")
    got = {r.k: r.n for r in history.with_version(rows, versions, "ref", "id", "at", {"n": F.col("n")}, "k").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: None, 6: None, 7: None, 8: 3}


def test_staging_is_removed_when_the_work_fails(spark):
    with pytest.raises(RuntimeError):
        with sinks.staging_table(spark, "x") as path:
            spark.range(1).write.parquet(path)
            raise RuntimeError("merge failed")
    assert not sinks.path_exists(spark, path)


def test_destination_names(spark):
    assert sinks.split_destination("d.t") == (None, "d", "t")
    assert sinks.split_destination("p.d.t") == ("p", "d", "t")
    with pytest.raises(ValueError):
        sinks.split_destination("t")


def test_materialized_table_keeps_the_old_version_when_a_build_fails(spark):
    root = run_dir(spark, "m")
    sinks.materialize_table(spark, spark.range(3), "mt_demo", root)
    with pytest.raises(Exception):
        sinks.materialize_table(spark, spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), "mt_demo", root)
    assert spark.table("mt_demo").count() == 3
    assert sinks.materialize_table(spark, spark.range(5), "mt_demo", root).count() == 5
