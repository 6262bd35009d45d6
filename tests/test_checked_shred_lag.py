import datetime as dt
import json

from pyspark.sql import functions as F

from fleetmart.operators import changes, checked, quality, shred
from fleetmart.plans import facts
from fleetmart.session import run_dir
from fleetmart.streaming import lag

LINES = [("unique", "id"), ("not_null", "s"), ("accepted_values", "s", ["a", "b"]), ("accepted_range", "id", 0, 1)]


def lines(report):
    return {(r.check_name, r.column_name): (r.failing, r.passed) for r in report.collect()}


def test_report_of_a_write_equals_the_report_of_the_table(spark, plan):
    source = run_dir(spark, "source")
    spark.range(5000).select((F.col("id") % 4990).alias("id"), F.when(F.col("id") % 7 > 0, F.chr(97 + F.col("id") % 3)).alias("s"), F.lit(dt.datetime(2026, 1, 5)).alias("at")).write.parquet(source)
    rows = spark.read.parquet(source)
    rules, unique = quality.suite(LINES)
    want = lines(quality.dq_report(rows, "t", rules, unique))
    for options in ({}, {"partition_col": "at", "cluster_cols": ["id"]}):
        path = run_dir(spark, "checked")
        report = checked.write_checked(rows, path, "t", rules, unique, **options)
        assert lines(report) == want and want[("unique", "id")] == (10, False)
        assert spark.read.parquet(path).count() == 5000
        # The report no longer depends on the input: uniqueness reads one column of the files written, the rest are counts.
        assert source not in plan(report) and plan(checked.write_checked(rows, path, "t", rules, [], **options)).count("FileScan") == 0


def test_empty_and_appended_writes(spark):
    rules, unique = quality.suite(LINES)
    path = run_dir(spark, "checked")
    one = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    empty = checked.write_checked(one.limit(0), path, "t", rules, unique)
    assert all(passed for _, passed in lines(empty).values()) and len(lines(empty)) == 4
    nothing = checked.write_checked(spark.createDataFrame([], one.schema), run_dir(spark, "checked"), "t", rules, unique)
    assert all(n == 0 for n, _ in lines(nothing).values())
    for again in (0, 1):
        got = lines(checked.write_checked(one, path, "t", rules, unique, mode="append"))
        assert got[("not_null", "s")] == (1, False) and got[("accepted_range", "id")] == (1, False)
        assert got[("unique", "id")] == (2 * again, not again)


def test_a_table_that_fails_its_checks_is_not_published(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS checked LOCATION '{run_dir(spark, 'db')}'")
    root, rules = run_dir(spark, "tables"), [quality.not_null("id")]
    good, bad = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(None,), (2,)], "id int")
    assert not checked.publish_checked(spark, bad, "checked.t", root, rules)[1] and not spark.catalog.tableExists("checked.t")
    assert checked.publish_checked(spark, good, "checked.t", root, rules, ["id"])[1]
    report, published = checked.publish_checked(spark, bad, "checked.t", root, rules)
    assert not published and report.first().failing == 1 and [r.id for r in spark.table("checked.t").collect()] == [1]
    assert checked.publish_checked(spark, bad, "checked.t", root, rules, tolerated={("not_null", "id"): 1})[1]
    assert spark.table("checked.t").count() == 2
    spark.sql("DROP DATABASE checked CASCADE")


DOCS = [
    '{"surge": 1.5, "zone": "Z1", "k": {"deep": [1, null]}}', '{"surge_multiplier": "2.5", "pickup_zone": 7}', '{"surge": "n/a", "zone": {"id": 3}, "driver_id": null}', '{"surge": true, "odd key.x": 1}',
    "{broken", "[1, 2]", "3", "", None, "{}", '{"reason": "{x", "fare": 12, "distance": [4]}', '{"reason": null, "cancellation_reason": "late", "fare": {"v": 1}, "total_fare": 9.25}',
]


def test_payload_fields_from_variants_equal_those_from_text(spark):
    events = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "event_id int, event_payload string")
    names = [name for name, _, _ in facts.PAYLOAD_FIELDS]
    for both in (True, False):
        want = {tuple(r) for r in facts.parse_event_payload(events, both).select("event_id", *names).collect()}
        rows = facts.parse_event_payload_variant(events, both)
        assert {tuple(r) for r in rows.select("event_id", *names).collect()} == want
    rest = {r.event_id: r.payload_rest for r in facts.parse_event_payload_variant(events).collect()}
    read = {i: json.loads(rest[i]) if rest[i] else None for i in (0, 1, 2, 3, 9, 10)}
    assert read[0] == {"k": {"deep": [1, None]}} and read[1] is None and read[2] == {"surge": "n/a", "zone": {"id": 3}, "driver_id": None}
    assert read[3] == {"surge": True, "odd key.x": 1} and read[9] is None and read[10] == {"distance": [4]}
    assert [rest[i] for i in (4, 5, 6, 7, 8)] == ["{broken", "[1, 2]", "3", "", None]


def test_members_are_found_and_nothing_is_lost(spark):
    docs = [json.dumps({"n": i, "t": f"w{i}", "B": i % 2 == 0, "b": 1, "mix": i if i % 2 else "x", "in": {"a": i}, f"id{i}": 1}) for i in range(60)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(99, "{"), (98, None)], "id int, doc string")
    found = shred.discover(df, "doc", 0.5, "p_")
    assert {(m.key, m.column, m.kind) for m in found} == {("n", "p_n", "bigint"), ("t", "p_t", "string"), ("B", "p_B", "boolean"), ("mix", "p_mix", "json"), ("in", "p_in", "json")}
    out = {r.id: r for r in shred.shred(df, "doc", found).collect()}
    for i, d in enumerate(docs):
        r = out[i]
        back = json.loads(r.rest) | {"n": r.p_n, "t": r.p_t, "B": r.p_B, "mix": json.loads(r.p_mix), "in": json.loads(r.p_in)}
        assert back == json.loads(d)
    assert out[99].rest == "{" and out[98].rest is None
    assert shred.discover(df.limit(0), "doc") == [] and shred.shred(df.limit(0), "doc", []).columns == ["id", "doc", "rest"]
    assert shred.shred(df.withColumn("_members", F.lit(1)), "doc", found).first()._members == 1


def test_lag_of_live_streams(spark):
    start = dt.datetime(2026, 1, 1)
    at = lambda s: start + dt.timedelta(seconds=s)
    # (application rows, change rows) by batch; late ones in the second and third, one far too late in the last.
    batches = [
        ([("r1", "ACCEPTED", 0), ("r2", "ACCEPTED", 50), ("r7", "ACCEPTED", 60), (None, "ACCEPTED", 5)], [("r1", "ACCEPTED", 4), ("r1", "PICKED_UP", 30)]),
        ([("r1", "PICKED_UP", 20), ("r3", "ACCEPTED", 400)], [("r2", "ACCEPTED", 45), ("r9", "ACCEPTED", 410)]),
        ([("r4", "ACCEPTED", 4000)], [("r3", "ACCEPTED", 395), ("r4", "ACCEPTED", 4090), ("r4", "ACCEPTED", 4700)]),
        ([("beat", "x", 90_000)], [("beat", "x", 90_000)]),
        ([("r5", "ACCEPTED", 60)], [("r5", "ACCEPTED", 61), ("beat", "x", 90_001)]),
        ([("beat", "x", 180_000)], [("beat", "x", 180_000)]),
    ]
    left, right = run_dir(spark, "app"), run_dir(spark, "log")
    out = {False: run_dir(spark, "lag"), True: run_dir(spark, "lag")}
    checkpoints = {False: run_dir(spark, "ck"), True: run_dir(spark, "ck")}
    schemas = "id string, status string, app timestamp", "id string, status string, log timestamp"
    for path, schema in zip((left, right), schemas):
        spark.createDataFrame([], schema).write.parquet(path)
    held = {}
    for rows in batches:
        for path, schema, side in zip((left, right), schemas, rows):
            spark.createDataFrame([(k, s, at(t)) for k, s, t in side], schema).coalesce(1).write.mode("append").parquet(path)
        for unanswered in (False, True):
            streams = [spark.readStream.schema(schema).parquet(path) for path, schema in zip((left, right), schemas)]
            pairs = lag.stream_app_vs_log_lag(*streams, "id", "status", "app", "log", "5 minutes", "10 minutes", unanswered)
            run = pairs.writeStream.format("parquet").option("checkpointLocation", checkpoints[unanswered]).trigger(availableNow=True).start(out[unanswered])
            run.awaitTermination()
            held[unanswered] = sum(s["numRowsTotal"] for s in run.lastProgress["stateOperators"])
    pairs = [(r.id, r.status, r.lag_seconds) for r in spark.read.parquet(out[False]).collect() if r.id != "beat"]
    sides = [spark.createDataFrame([(k, s, at(t)) for b in batches for k, s, t in b[i] if k not in ("beat", "r5")], schemas[i]) for i in (0, 1)]
    batch = changes.app_vs_log_lag(*sides, "id", "status", "app", "log").where("abs(lag_seconds) <= 300")
    assert sorted(pairs) == sorted((r.id, r.status, r.lag_seconds) for r in batch.collect())
    assert sorted(pairs) == [("r1", "ACCEPTED", 4), ("r1", "PICKED_UP", 10), ("r2", "ACCEPTED", -5), ("r3", "ACCEPTED", -5), ("r4", "ACCEPTED", 90)]
    # What the watermark has passed is freed: only the last heartbeats are held.
    assert held[False] <= 2 and held[True] <= 2
    assert [r.id for r in spark.read.parquet(out[True]).collect() if r.id != "beat" and r.lag_seconds is None] == ["r7"]
