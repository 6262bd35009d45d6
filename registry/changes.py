"""Change events, timelines and the streams built on them. Streams run to the end of their input and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators import changes
from fleetmart.operators.sequence import row_slices, with_neighbour
from fleetmart.plans import timeline
from fleetmart.session import run_dir, state_partitions
from fleetmart.sources import readers
from fleetmart.streaming import apply, lag, landing, throttle
from registry.checks import status_log
from registry.core import CTES, now, query

TOPIC = "cdc.public.customers"
INPUT_FILES = 4
#: Micro-batches of a stream that is read in several.
BATCHES = 4

CTES["o_env"] = """SELECT customer_id, status, ts, lsn, op, epoch_ms(ts) AS ts_ms,
 lag(status) OVER (PARTITION BY customer_id ORDER BY ts, lsn) AS before_status FROM {change_log}"""


def envelopes(d):
    """The change log as nested change events with the row before and after."""
    log = with_neighbour(
        d.table("change_log"), ["customer_id"], ["ts", "lsn"], {"before_status": "status", "before_ts": "ts"}, row_slices(d.table("change_log"), "ts"), previous=True
    )
    row = lambda status, ts: F.struct(F.col("customer_id"), F.col(status).alias("status"), F.col(ts).alias("updated_at"))
    ms = F.unix_millis("ts")
    deleted = F.col("op") == "d"
    return log.select(
        "op",
        ms.alias("ts_ms"),
        F.when(deleted, row("status", "ts")).when(F.col("before_status").isNotNull(), row("before_status", "before_ts")).alias("before"),
        F.when(~deleted, row("status", "ts")).alias("after"),
        F.struct(F.lit("ride_ops_pg").alias("db"), F.lit("customers").alias("table"), F.col("lsn"), ms.alias("ts_ms")).alias("source"),
    )


def as_files(d, df, name, order):
    """A stream's input: the rows in several files."""
    path = run_dir(d.spark, name)
    df.repartitionByRange(max(INPUT_FILES, d.spark.sparkContext.defaultParallelism), order).write.parquet(path)
    return path


UNWRAPPED = """SELECT customer_id, status, ts AS updated_at, op AS __op, ts_ms AS __source_ts_ms, 'customers' AS __table, lsn AS __lsn, op = 'd' AS __deleted FROM {o_env}"""


@query("cdc_unwrap", UNWRAPPED)
def _(d):
    return changes.cdc_unwrap(envelopes(d))


@query(
    "cdc_unwrap_documents",
    """SELECT event_id AS _id, CASE WHEN op <> 'd' THEN user_id END AS user_id, CASE WHEN op <> 'd' THEN event_type END AS event_type, op AS __op, epoch_us(ts) // 1000 AS __source_ts_ms,
       collection AS __collection, op = 'd' AS __deleted FROM (SELECT *, CASE WHEN event_id % 19 = 0 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS op,
       CASE WHEN event_id % 2 = 0 THEN 'ride_events' ELSE 'driver_locations' END AS collection FROM events)""",
)
def _(d):
    key = F.col("event_id")
    op = F.when(key % 19 == 0, "d").when(key % 3 == 0, "u").otherwise("c")
    text = F.to_json(F.struct(key.alias("_id"), "user_id", "event_type", F.col("props").alias("payload")))
    source = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.when(key % 2 == 0, "ride_events").otherwise("driver_locations").alias("collection"))
    sent = d.table("events").select(op.alias("op"), key.alias("_id"), F.when(op != "d", text).alias("after"), source.alias("source"))
    return changes.cdc_unwrap_documents(sent, T.StructType.fromDDL("_id long, user_id long, event_type string"))


@query("cdc_rewrite_deletes", UNWRAPPED + " WHERE op = 'd'")
def _(d):
    return changes.cdc_unwrap(envelopes(d), drop_tombstones=True).filter("__deleted")


@query("cdc_flatten_before_after", "SELECT op, customer_id, CASE WHEN op = 'd' THEN status ELSE before_status END AS status_before, CASE WHEN op <> 'd' THEN status END AS status_after, ts AS event_ts, lsn FROM {o_env}")
def _(d):
    return changes.cdc_flatten_before_after(envelopes(d), "customer_id", ["status"])


@query("op_filter", "SELECT op, customer_id, lsn FROM {o_env} WHERE op IN ('c', 'u')")
def _(d):
    return changes.op_filter(d.table("change_log")).select("op", "customer_id", "lsn")


@query(
    "snapshot_initial_read",
    "SELECT 'C-' || c_custkey::varchar AS customer_id, NULL::varchar AS status, 'r' AS op FROM customer UNION ALL SELECT customer_id, status, op FROM {change_log}",
)
def _(d):
    table = d.table("customer").select(F.concat(F.lit("C-"), "c_custkey").alias("customer_id"))
    return changes.snapshot_initial_read(table, d.table("change_log").select("customer_id", "status", "op"))


LATEST = """SELECT customer_id, status, ts AS updated_at, op AS __op, lsn AS __lsn FROM
 (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, lsn DESC) AS rn FROM {o_env}) WHERE rn = 1 AND op <> 'd'"""
STATE_COLUMNS = ["customer_id", "status", "updated_at", "__op", "__lsn"]


@query("cdc_apply", LATEST)
def _(d):
    # Two rounds; the second repeats part of the first, which changes nothing.
    rows = changes.cdc_unwrap(envelopes(d))
    early, late = rows.filter("updated_at < '1998-06-01'"), rows.filter("updated_at >= '1997-06-01'")
    first = changes.cdc_apply(None, early, ["customer_id"], keep_deleted=True)
    return changes.cdc_apply(first, late, ["customer_id"]).select(*STATE_COLUMNS)


CTES["o_status_changes"] = """SELECT ride_id, 'ACCEPTED' AS status, accepted_at AS event_ts FROM {rides} WHERE accepted_at IS NOT NULL
 UNION ALL SELECT ride_id, 'PICKED_UP', picked_up_at FROM {rides} WHERE picked_up_at IS NOT NULL
 UNION ALL SELECT ride_id, 'COMPLETED', completed_at FROM {rides} WHERE completed_at IS NOT NULL"""


@query(
    "app_vs_log_lag",
    """SELECT a.ride_id, a.status, a.ts AS app_recorded_ts, c.event_ts AS wal_recorded_ts, date_sub('second', a.ts, c.event_ts) AS lag_seconds
       FROM {o_log} a JOIN {o_status_changes} c ON c.ride_id = a.ride_id AND c.status = a.status""",
)
def _(d):
    stages = F.array(*[F.struct(F.lit(s).alias("status"), F.col(c).alias("event_ts")) for s, c in (("ACCEPTED", "accepted_at"), ("PICKED_UP", "picked_up_at"), ("COMPLETED", "completed_at"))])
    moved = d.table("rides").select("ride_id", F.explode(stages).alias("s")).select("ride_id", "s.status", "s.event_ts").filter("event_ts IS NOT NULL")
    return changes.app_vs_log_lag(status_log(d), moved, "ride_id", "status", "ts", "event_ts")


# Timelines -----------------------------------------------------------------------------------------------------------

CTES["o_trip_events"] = """SELECT ride_id AS trip_id, occurred_at AS event_ts, CASE event_type WHEN 'RIDE_REQUESTED' THEN 'requested' WHEN 'RIDE_ACCEPTED' THEN 'driver_accepted'
 WHEN 'PASSENGER_PICKED_UP' THEN CASE WHEN substr(event_id, 3)::bigint % 2 = 0 THEN 'driver_arrived' ELSE 'trip_started' END
 WHEN 'RIDE_COMPLETED' THEN 'completed' ELSE 'cancelled' END AS status_code FROM {ride_events}"""


def trip_events(d):
    arrived = F.when(F.substring("event_id", 3, 18).cast("long") % 2 == 0, "driver_arrived").otherwise("trip_started")
    kind = F.col("event_type")
    code = (
        F.when(kind == "RIDE_REQUESTED", "requested").when(kind == "RIDE_ACCEPTED", "driver_accepted")
        .when(kind == "PASSENGER_PICKED_UP", arrived).when(kind == "RIDE_COMPLETED", "completed").otherwise("cancelled")
    )
    return d.table("ride_events").select(F.col("ride_id").alias("trip_id"), F.col("occurred_at").alias("event_ts"), code.alias("status_code"))


def _first(code: str) -> str:
    return f"min(event_ts) FILTER (status_code = '{code}')"


def _span(unit: str, a: str, b: str) -> str:
    return f"date_sub('{unit}', {a}, {b})"


TIMELINE_SQL = f"""
WITH p AS (SELECT trip_id, {_first('requested')} AS ts_requested, {_first('driver_accepted')} AS ts_driver_accepted, {_first('driver_arrived')} AS ts_driver_arrived,
  {_first('trip_started')} AS ts_trip_started, {_first('completed')} AS ts_trip_completed, {_first('cancelled')} AS ts_trip_cancelled FROM {{o_trip_events}} GROUP BY ALL)
SELECT *, {_span('second', 'ts_requested', 'ts_driver_accepted')} AS sec_request_to_accepted, {_span('second', 'ts_driver_accepted', 'ts_driver_arrived')} AS sec_accepted_to_arrived,
  {_span('second', 'ts_driver_arrived', 'ts_trip_started')} AS sec_arrived_to_started, {_span('second', 'ts_trip_started', 'ts_trip_completed')} AS sec_trip_duration,
  {_span('second', 'ts_driver_accepted', 'ts_trip_cancelled')} AS sec_accepted_to_cancelled,
  CASE WHEN ts_trip_cancelled IS NOT NULL THEN CASE WHEN coalesce({_span('minute', 'ts_driver_arrived', 'ts_trip_cancelled')}, 999999) <= 5 THEN 'no_show'
    WHEN coalesce({_span('minute', 'ts_driver_accepted', 'ts_trip_cancelled')}, 10) <= 3 THEN 'early_cancel'
    WHEN coalesce({_span('minute', 'ts_driver_accepted', 'ts_trip_cancelled')}, 10) > 15 THEN 'long_wait_cancel' ELSE 'normal_cancel' END END AS cancel_pattern
FROM p"""


# The change log of trip statuses also holds deletes and first reads, which the timeline leaves out.
CTES["o_trip_changes"] = """SELECT trip_id, event_ts, status_code, CASE WHEN epoch_ms(event_ts) // 1000 % 13 = 0 THEN 'd' WHEN epoch_ms(event_ts) // 1000 % 13 = 1 THEN 'r'
 WHEN status_code = 'requested' THEN 'c' ELSE 'u' END AS op FROM {o_trip_events}"""
CHANGES_SQL = TIMELINE_SQL.replace("{o_trip_events}", "(SELECT * FROM {o_trip_changes} WHERE op IN ('c', 'u'))")


def trip_changes(d):
    """Status changes as change events with the row before and after."""
    part = F.unix_seconds("event_ts") % 13
    op = F.when(part == 0, "d").when(part == 1, "r").when(F.col("status_code") == "requested", "c").otherwise("u")
    row = F.struct("trip_id", "status_code", "event_ts")
    shape = trip_events(d).withColumn("op", op)
    return shape.select("op", F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"))


@query("fct_trip_status_timeline", CHANGES_SQL)
def _(d):
    kept = changes.op_filter(trip_changes(d)).select("after.*")
    return timeline.fct_trip_status_timeline(kept)


@query(
    "status_durations",
    "SELECT event_id, ride_id, status, ts, lead(ts) OVER w AS next_ts, date_sub('minute', ts, lead(ts) OVER w) AS minutes_to_next FROM {o_log} WINDOW w AS (PARTITION BY ride_id ORDER BY ts, event_id)",
)
def _(d):
    return timeline.status_durations(status_log(d), "ride_id", "ts", "event_id")


# Streams -------------------------------------------------------------------------------------------------------------


@query("stream_unwrap_changes", UNWRAPPED)
def _(d):
    env = envelopes(d)
    path = as_files(d, env, "envelopes", "ts_ms")
    out = run_dir(d.spark, "unwrapped")
    rows = landing.stream_unwrap_changes(landing.read_envelopes(d.spark, path, env.schema, max_files=2))
    rows.writeStream.format("parquet").option("checkpointLocation", run_dir(d.spark, "ck")).trigger(availableNow=True).start(out).awaitTermination()
    return d.spark.read.parquet(out)


@query("stream_land", f"SELECT '{TOPIC}' AS topic, '2026' AS year, '01' AS month, '02' AS day, '03' AS hour, status, count(*) AS rows FROM {{o_env}} GROUP BY ALL")
def _(d):
    env = envelopes(d)
    path = as_files(d, env, "envelopes", "ts_ms")
    out = run_dir(d.spark, "landing")
    rows = landing.stream_unwrap_changes(landing.read_envelopes(d.spark, path, env.schema))
    # A fixed clock of 20:30 UTC is 03:30 on the next day in the landing zone.
    landing.stream_land(rows, out, run_dir(d.spark, "ck"), TOPIC, clock=now("2026-01-01 20:30:00")).awaitTermination()
    landed = d.spark.read.option("basePath", out).schema("status string, topic string, year string, month string, day string, hour string").parquet(out)
    return landed.groupBy(*landing.LANDING_LAYOUT, "status").agg(F.count("*").alias("rows"))


@query("land_change_stream", "SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers FROM {o_env}")
def _(d):
    env = envelopes(d)
    path = as_files(d, env, "envelopes", "ts_ms")
    out = run_dir(d.spark, "landing")
    rows = landing.stream_unwrap_changes(landing.read_envelopes(d.spark, path, env.schema, max_files=1))
    landing.stream_land(rows, out, run_dir(d.spark, "ck"), TOPIC).awaitTermination()
    return readers.scan_landing(d.spark, out).agg(F.count("*").alias("rows"), F.count_distinct("customer_id").alias("customers"))


@query("roll_files", "SELECT true AS within_limit, count(*) AS rows FROM {o_env}")
def _(d):
    env = envelopes(d)
    path = as_files(d, env, "envelopes", "ts_ms")
    out = run_dir(d.spark, "landing")
    rows = landing.stream_unwrap_changes(landing.read_envelopes(d.spark, path, env.schema))
    landing.stream_land(rows, out, run_dir(d.spark, "ck"), TOPIC, clock=now("2026-01-01 20:30:00")).awaitTermination()
    per_file = readers.scan_landing(d.spark, out).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return per_file.agg((F.max("n") <= landing.RECORDS_PER_FILE).alias("within_limit"), F.sum("n").alias("rows"))


RECORD = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("lsn", T.LongType())])


def record_text(d):
    """Change rows as JSON text, every fiftieth cut short."""
    doc = F.to_json(F.struct("customer_id", "status", "lsn"))
    cut = F.when(F.col("lsn") % 50 == 0, F.expr("substr(doc, 1, length(doc) - 4)")).otherwise(F.col("doc"))
    return d.table("change_log").withColumn("doc", doc).select(cut.alias("value"), "lsn")


def _dead_letter(d):
    path = as_files(d, record_text(d), "records", "lsn")
    good, dlq = run_dir(d.spark, "good"), run_dir(d.spark, "dlq")
    text = d.spark.readStream.schema("value string, lsn long").option("maxFilesPerTrigger", 2).parquet(path).select("value")
    landing.stream_dlq(text, RECORD, good, dlq, run_dir(d.spark, "ck"), source=TOPIC).awaitTermination()
    return d.spark.read.parquet(good), d.spark.read.parquet(dlq)


@query("stream_dlq", "SELECT customer_id, status, lsn FROM {change_log} WHERE lsn % 50 <> 0")
def _(d):
    return _dead_letter(d)[0].select("customer_id", "status", "lsn")


@query("dead_letter", f"SELECT '{TOPIC}' AS source, count(*) AS failed FROM {{change_log}} WHERE lsn % 50 = 0")
def _(d):
    return _dead_letter(d)[1].groupBy("source").agg(F.count("raw").alias("failed"))


@query("stream_apply", LATEST)
def _(d):
    env = envelopes(d)
    # Half of the log, folded into a base; then the other half on top. Every seventh event of the first half comes late.
    low, high = env.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    early = (F.col("ts_ms") < (low + high) // 2) & (F.col("source.lsn") % 7 != 0)
    path, out, ck = run_dir(d.spark, "envelopes"), run_dir(d.spark, "applied"), run_dir(d.spark, "ck")
    files = max(INPUT_FILES, d.spark.sparkContext.defaultParallelism)
    for part in (early, ~early):
        env.where(part).repartitionByRange(files, "ts_ms").write.mode("append").parquet(path)
        rows = landing.stream_unwrap_changes(landing.read_envelopes(d.spark, path, env.schema, max_files=files // 2))
        apply.stream_apply(rows, out, ck, ["customer_id"]).awaitTermination()
        if part is early:
            apply.compact(d.spark, out, ["customer_id"])
    return apply.applied_state(d.spark, out, ["customer_id"]).select(*STATE_COLUMNS)


@query("hourly_incremental_load", "SELECT count(*) AS rows, count(DISTINCT lsn) AS distinct_rows FROM {change_log}")
def _(d):
    log = d.table("change_log")
    path, out, ck = as_files(d, log, "hour", "lsn"), run_dir(d.spark, "raw"), run_dir(d.spark, "ck")
    for _run in range(2):  # the second run finds no new file and appends nothing
        landing.hourly_incremental_load(d.spark, path, log.schema, out, ck)
    return d.spark.read.parquet(out).agg(F.count("*").alias("rows"), F.count_distinct("lsn").alias("distinct_rows"))


@query("stream_late_data", "SELECT event_id, ts FROM events")
def _(d):
    events = d.table("events").select("event_id", "ts")
    repeated = events.unionByName(events.filter("event_id % 3 = 0"))
    path, out = as_files(d, repeated, "late", "ts"), run_dir(d.spark, "dedup")
    rows = landing.stream_late_data(d.spark.readStream.schema(repeated.schema).parquet(path), "ts", ["event_id"])
    rows.writeStream.format("parquet").option("checkpointLocation", run_dir(d.spark, "ck")).trigger(availableNow=True).start(out).awaitTermination()
    return d.spark.read.parquet(out)


@query("stream_trip_timeline", TIMELINE_SQL)
def _(d):
    events = trip_events(d)
    path, out = as_files(d, events, "trips", "event_ts"), run_dir(d.spark, "timeline")
    files = -(-max(INPUT_FILES, d.spark.sparkContext.defaultParallelism) // BATCHES)
    source = d.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)
    apply.stream_trip_timeline(source, out, run_dir(d.spark, "ck")).awaitTermination()
    return apply.current_timeline(d.spark, out)


# The change stream's record of each status: half a minute before to a quarter of an hour after the application's.
CTES["o_log_changes"] = "SELECT ride_id, status, ts + to_seconds(substr(event_id, 3)::bigint % 901 - 30) AS event_ts FROM {o_log}"


@query(
    "stream_app_vs_log_lag",
    """SELECT a.ride_id, a.status, a.ts AS app_recorded_ts, c.event_ts AS wal_recorded_ts, date_sub('second', a.ts, c.event_ts) AS lag_seconds FROM {o_log} a
       JOIN {o_log_changes} c ON c.ride_id = a.ride_id AND c.status = a.status AND c.event_ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 1 HOUR""",
)
def _(d):
    number = F.substring("event_id", 3, 18).cast("long")
    log = status_log(d).withColumn("number", number)
    app = log.select("ride_id", "status", "ts", "number")
    moved = log.select("ride_id", "status", F.timestamp_add("SECOND", number % 901 - 30, "ts").alias("event_ts"), "number")
    low, high = app.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    out, ck, sides = run_dir(d.spark, "lag"), run_dir(d.spark, "ck"), []
    # On both sides every tenth row comes two hours late; the streams go on from their checkpoint after each batch.
    for name, rows, at, turn in (("app", app, "ts", 0), ("moved", moved, "event_ts", 5)):
        arrived = F.unix_seconds(at) + F.when(F.col("number") % 10 == turn, 2 * 3600).otherwise(0)
        batch = F.greatest(F.least(F.floor((arrived - low) * BATCHES / max(high - low, 1)), F.lit(BATCHES - 1)), F.lit(0))
        path = run_dir(d.spark, name)
        rows.limit(0).drop("number").write.parquet(path)
        sides.append((path, rows.drop("number").schema, rows.withColumn("_batch", batch).drop("number")))
    streams = [d.spark.readStream.schema(schema).parquet(path) for path, schema, _ in sides]
    pairs = lag.stream_app_vs_log_lag(*streams, "ride_id", "status", "ts", "event_ts", "1 hour", "3 hours")
    for k in range(BATCHES):
        for path, _, rows in sides:
            rows.where(F.col("_batch") == k).drop("_batch").write.mode("append").parquet(path)
        pairs.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()
    return d.spark.read.schema(pairs.schema).parquet(out)


@query("scan_topic", "SELECT topic, count(*) AS rows FROM (SELECT CASE WHEN lsn % 2 = 0 THEN 'cdc.public.rides' ELSE 'cdc.public.zones' END AS topic FROM {change_log} WHERE lsn % 5 <> 0) GROUP BY ALL")
def _(d):
    name = F.when(F.col("lsn") % 5 == 0, "cdc.public.payments").when(F.col("lsn") % 2 == 0, "cdc.public.rides").otherwise("cdc.public.zones")
    log = d.table("change_log").select("customer_id", "lsn")
    root, out = run_dir(d.spark, "topics"), run_dir(d.spark, "read")
    log.withColumn("topic", name).write.partitionBy("topic").parquet(root)
    stream = readers.scan_topic_files(d.spark, root, T.StructType(list(log.schema)))
    stream.writeStream.format("parquet").option("checkpointLocation", run_dir(d.spark, "ck")).trigger(availableNow=True).start(out).awaitTermination()
    return d.spark.read.parquet(out).groupBy("topic").agg(F.count("*").alias("rows"))


PING_GAP = 12 * 3600
THIN_SQL = f"""
WITH RECURSIVE kept(user_id, ts) AS (
  SELECT user_id, min(ts) FROM events GROUP BY ALL
  UNION ALL
  SELECT k.user_id, (SELECT min(e.ts) FROM events e WHERE e.user_id = k.user_id AND e.ts >= k.ts + INTERVAL {PING_GAP} SECOND)
  FROM kept k WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = k.user_id AND e.ts >= k.ts + INTERVAL {PING_GAP} SECOND)
)
SELECT e.event_id, e.user_id, e.ts FROM events e JOIN kept k ON k.user_id = e.user_id AND k.ts = e.ts"""


def pings(d):
    return d.table("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))


@query("ping_downsample", THIN_SQL)
def _(d):
    # Eight gaps to a slice, so that most users cross many slices.
    return throttle.ping_downsample(pings(d), "user_id", "ts", PING_GAP, 8)


@query("stream_ping_downsample", THIN_SQL)
def _(d):
    # Batches in the order of arrival; every tenth ping comes half a day late. A heartbeat from far ahead closes the stream.
    rows = pings(d)
    path, out, ck = run_dir(d.spark, "pings"), run_dir(d.spark, "kept"), run_dir(d.spark, "ck")
    rows.limit(0).write.parquet(path)
    arrived = F.unix_seconds("ts") + F.when(F.col("event_id") % 10 == 0, 12 * 3600).otherwise(0)
    timed = rows.withColumn("arrived", arrived)
    low, high = timed.agg(F.min("arrived"), F.max("arrived")).first()
    batch = F.least(F.floor((F.col("arrived") - low) * BATCHES / max(high - low, 1)), F.lit(BATCHES - 1))
    beat = d.spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), now("2100-01-01 00:00:00").alias("ts"))
    source = d.spark.readStream.schema(rows.schema).parquet(path)
    kept = throttle.stream_ping_downsample(source, "user_id", "ts", PING_GAP, "1 day")
    # A batch is written by as many tasks as there are, and the stream goes on from its checkpoint once it is there.
    for k in range(BATCHES + 1):
        arriving = timed.where(batch == k).drop("arrived") if k < BATCHES else beat
        arriving.write.mode("append").parquet(path)
        with state_partitions(d.spark):
            kept.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()
    return d.spark.read.schema(rows.schema).parquet(out).where("event_id >= 0")
