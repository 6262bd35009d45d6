import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators import changes, quality
from fleetmart.session import run_dir
from fleetmart.streaming import throttle


def test_documents_are_unwrapped(spark):
    sent = spark.createDataFrame(
        [("c", "k1", '{"_id": "k1", "n": 3, "deep": {"x": [1]}}', (5, "a")), ("d", "k2", None, (6, "a")), ("u", "k3", "{broken", (7, "b")), (None, None, None, None)],
        "op string, _id string, after string, source struct<ts_ms: long, collection: string>",
    )
    shape = T.StructType.fromDDL("_id string, n int, deep struct<x: array<int>>")
    rows = [tuple(r) for r in changes.cdc_unwrap_documents(sent, shape).collect()]
    assert [(r[0], r[1], r[3], r[4], r[5], r[6]) for r in rows] == [("k1", 3, "c", 5, "a", False), ("k2", None, "d", 6, "a", True), ("k3", None, "u", 7, "b", False), (None, None, None, None, None, None)]
    assert changes.cdc_unwrap_documents(sent, shape, drop_tombstones=True).count() == 3


def test_reports_of_several_tables(spark):
    one = spark.createDataFrame([(1, "a"), (1, None), (2, "x")], "id int, s string")
    lines = [("unique", "id"), ("not_null", "s"), ("accepted_values", "s", ["a", "b"]), ("accepted_range", "id", 0, 1)]
    report = quality.dq_report_all({"one": (one, quality.suite(lines)), "none": (one.limit(0), quality.suite(lines))})
    got = {(r.table_name, r.check_name): (r.failing, r.passed) for r in report.collect()}
    assert got[("one", "unique")] == (1, False) and got[("one", "not_null")] == (1, False) and got[("one", "accepted_values")] == (1, False) and got[("one", "accepted_range")] == (1, False)
    assert all(passed for (table, _), (_, passed) in got.items() if table == "none") and len(got) == 8


def test_late_pings_are_kept_within_the_limit(spark):
    start = dt.datetime(2026, 1, 1)
    at = lambda s: start + dt.timedelta(seconds=s)
    path, out = run_dir(spark, "pings"), run_dir(spark, "kept")
    batches = [[("a", 0), ("a", 100), ("b", 5)], [("a", 20), ("a", 40), ("a", 120), ("b", 16)], [("a", 44), ("a", 130)], [("beat", 100_000)]]
    for batch in batches:
        spark.createDataFrame([(k, at(s)) for k, s in batch], "driver string, at timestamp").coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema("driver string, at timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    kept = throttle.stream_ping_downsample(source, "driver", "at", 10, "200 seconds")
    kept.writeStream.format("parquet").option("checkpointLocation", run_dir(spark, "ck")).trigger(availableNow=True).start(out).awaitTermination()
    got = sorted((r.driver, int((r.at - start).total_seconds())) for r in spark.read.parquet(out).collect())
    every = spark.createDataFrame([(k, at(s)) for b in batches for k, s in b], "driver string, at timestamp")
    want = sorted((r.driver, int((r.at - start).total_seconds())) for r in throttle.ping_downsample(every, "driver", "at", 10).collect())
    assert [x for x in got if x[0] != "beat"] == [x for x in want if x[0] != "beat"] == [("a", 0), ("a", 20), ("a", 40), ("a", 100), ("a", 120), ("a", 130), ("b", 5), ("b", 16)]
