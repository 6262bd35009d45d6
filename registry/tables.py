"""Readers and writers: each writes the rows of a whole table and reads the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators import curve, sinks
from fleetmart.operators.ingest import cast_to_contract
from fleetmart.plans import marts, planned
from fleetmart.session import run_dir
from fleetmart.sources import readers
from fleetmart.sources.contracts import SPECS
from registry.core import now, query
from registry.ingest import NEWER2, batches
from registry.silver import RIDE_DECIMALS

RIDE_ROWS = "SELECT ride_id, ride_status, requested_at, total_fare::double AS total_fare FROM {rides}"


def ride_rows(d):
    return d.table("rides").select("ride_id", "ride_status", "requested_at", "total_fare")


@query("write_partitioned", RIDE_ROWS)
def _(d):
    path = run_dir(d.spark, "rides")
    sinks.write_partitioned(ride_rows(d), path, "requested_at", "MONTH", ["ride_status"])
    return sinks.read_table(d.spark, path)


@query("clustered_write", "SELECT date_trunc('year', requested_at)::date AS year, count(*) AS rides FROM {rides} GROUP BY ALL")
def _(d):
    path = run_dir(d.spark, "rides")
    sinks.write_partitioned(ride_rows(d), path, "requested_at", "YEAR", ["ride_status", "requested_at"])
    return d.spark.read.parquet(path).groupBy(F.col(sinks.PARTITION_COLUMN).alias("year")).agg(F.count("*").alias("rides"))


@query("write_mode", "SELECT zone_id, zone_code FROM {zones} UNION ALL SELECT zone_id, zone_code FROM {zones}")
def _(d):
    path = run_dir(d.spark, "zones")
    rows = d.table("zones").select("zone_id", "zone_code")
    for disposition in ("WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_APPEND"):
        sinks.write_mode(rows, path, disposition)
    return d.spark.read.parquet(path)


@query("write_query_result", "SELECT upper(ride_status) AS ride_status, count(*) AS rides FROM {rides} GROUP BY ALL")
def _(d):
    d.table("rides").createOrReplaceTempView("fm_rides")
    statements = [
        "CREATE OR REPLACE TEMPORARY VIEW fm_status AS SELECT upper(ride_status) AS ride_status FROM fm_rides",
        "SELECT ride_status, count(*) AS rides FROM fm_status GROUP BY ride_status",
    ]
    name = f"fm_{uuid.uuid4().hex[:8]}"
    return sinks.write_query_result(d.spark, statements, f"{name}.status_counts", run_dir(d.spark, "db"))


@query(
    "append_day_ingest_partition",
    "SELECT DATE '2026-01-01' AS _ingest_date, count(*) AS rows FROM {change_log} WHERE lsn % 2 = 0 UNION ALL SELECT DATE '2026-01-02', count(*) FROM {change_log} WHERE lsn % 2 = 1",
)
def _(d):
    path = run_dir(d.spark, "raw")
    log = d.table("change_log")
    for rest, day in ((0, "2026-01-01"), (1, "2026-01-02")):
        sinks.append_day_ingest_partition(log.filter(F.col("lsn") % 2 == rest), path, F.lit(day).cast("date"))
    return d.spark.read.parquet(path).groupBy("_ingest_date").agg(F.count("*").alias("rows"))


@query("staging_table", "SELECT count(*) AS rides, count(DISTINCT driver_id) AS drivers FROM {rides}")
def _(d):
    kept = run_dir(d.spark, "kept")
    with sinks.staging_table(d.spark, "rides") as path:
        d.table("rides").write.parquet(path)
        d.spark.read.parquet(path).agg(F.count("*").alias("rides"), F.count_distinct("driver_id").alias("drivers")).write.parquet(kept)
    if sinks.path_exists(d.spark, path):
        raise RuntimeError("staging folder left behind")
    return d.spark.read.parquet(kept)


@query("materialize_view", "SELECT zone_id, zone_code, city FROM {zones}")
def _(d):
    name = f"fm_zones_{uuid.uuid4().hex[:8]}"
    sinks.materialize_view(d.table("zones"), name)
    return d.spark.table(name).select("zone_id", "zone_code", "city")


@query("materialize_table", "SELECT passenger_id, loyalty_tier, home_zone_code FROM {o_passengers}")
def _(d):
    name, root = f"fm_passengers_{uuid.uuid4().hex[:8]}", run_dir(d.spark, "tables")
    rows = d.passengers.select("passenger_id", "loyalty_tier", "home_zone_code")
    sinks.materialize_table(d.spark, rows.filter("loyalty_tier = 'Gold'"), name, root)
    return sinks.materialize_table(d.spark, rows, name, root)


@query("materialize_incremental", f"SELECT * REPLACE ({RIDE_DECIMALS}) FROM {{o_rides}}")
def _(d):
    # The fact is stored, then the rides updated in the last years of the log are rebuilt and merged by ride id.
    path = run_dir(d.spark, "fct_rides")
    sinks.merge_table(d.spark, path, d.rides.filter("requested_date < '2000-07-01'"), ["ride_id"], ["updated_at"], "requested_at", "YEAR", "overwrite")
    fresh = d.rides.filter("updated_at >= '2000-01-01'")
    sinks.merge_table(d.spark, path, fresh, ["ride_id"], ["updated_at"], "requested_at", "YEAR", "overwrite")
    return sinks.read_table(d.spark, path)


@query("merge_table", NEWER2)
def _(d):
    # Rows change their day between the batches, so partitions lose rows to others.
    path = run_dir(d.spark, "merged")
    for batch in batches(d):
        sinks.merge_table(d.spark, path, batch, ["id"], ["updated_at"], "day", "DAY")
    return sinks.read_table(d.spark, path)


NULL_DAY = "(id % 5 = 0 AND tag = 'v0') OR (id % 5 = 1 AND tag = 'v2')"


@query("merge_table_null_partition", f"SELECT * REPLACE (CASE WHEN {NULL_DAY} THEN NULL ELSE day END AS day) FROM ({NEWER2})")
def _(d):
    # Rows stand in the NULL partition, enter it and leave it.
    path = run_dir(d.spark, "merged")
    for batch in batches(d):
        batch = batch.withColumn("day", F.when(~F.expr(NULL_DAY), F.col("day")))
        sinks.merge_table(d.spark, path, batch, ["id"], ["updated_at"], "day", "DAY")
    return sinks.read_table(d.spark, path)


@query("merge_table_new_column", f"SELECT *, CASE WHEN tag <> 'v0' THEN tag || '/' || status END AS note FROM ({NEWER2})")
def _(d):
    path = run_dir(d.spark, "merged")
    for i, batch in enumerate(batches(d)):
        batch = batch.withColumn("note", F.concat_ws("/", "tag", "status")) if i else batch
        sinks.merge_table(d.spark, path, batch, ["id"], ["updated_at"], "day", "DAY")
    return sinks.read_table(d.spark, path)


@query("merge_table_append_only", "SELECT * FROM {batch0} UNION ALL SELECT * FROM {batch1} WHERE id NOT IN (SELECT id FROM {batch0})")
def _(d):
    path = run_dir(d.spark, "log")
    b0, b1, _ = batches(d)
    for batch in (b0, b1, b1):
        sinks.merge_table(d.spark, path, batch, ["id"], ["updated_at"], "day", "DAY", "append_only")
    return sinks.read_table(d.spark, path)


@query("partition_overwrite", "SELECT date_key, city, total_trip_requested, total_trip_completed FROM {o_trip_daily}")
def _(d):
    path = run_dir(d.spark, "daily")
    daily = planned.dm_trip_daily_city(d.table("trips"), d.zones).select("city", "total_trip_requested", "total_trip_completed", "date_key")
    by_month = daily.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("long"))
    stale = by_month.withColumn("total_trip_completed", F.when(F.col("month_key") == 199703, -1).otherwise(F.col("total_trip_completed")).cast("long"))
    sinks.partition_overwrite(stale, path, "month_key")
    sinks.partition_overwrite(by_month.filter("month_key = 199703"), path, "month_key")
    return d.spark.read.parquet(path).select("date_key", "city", "total_trip_requested", "total_trip_completed")


@query("scan_relational", "SELECT driver_id, status, rating::double AS rating, updated_at FROM {drivers} WHERE status = 'ACTIVE'")
def _(d):
    # The operational table as its exported extract under the declared schema; the JDBC form needs a running database.
    path = run_dir(d.spark, "extract")
    spec = SPECS["drivers"]
    cast_to_contract(d.table("drivers"), spec).write.parquet(path)
    return readers.scan_declared(d.spark, spec, path).filter("status = 'ACTIVE'").select("driver_id", "status", "rating", "updated_at")


DOCUMENT = T.StructType(
    [
        T.StructField("_id", T.StringType()), T.StructField("ride_id", T.StringType()), T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("payload", T.StructType([T.StructField("k", T.LongType()), T.StructField("surge", T.DoubleType())])),
    ]
)


@query("clustered_write_curve", RIDE_ROWS)
def _(d):
    path = run_dir(d.spark, "rides")
    curve.write_curve(ride_rows(d), path, ["ride_status", "requested_at", "total_fare"], 2000)
    return d.spark.read.parquet(path)


@query(
    "scan_documents",
    """SELECT event_id AS _id, ride_id, event_type, occurred_at AS event_time, CASE WHEN json_valid(event_payload) THEN json_extract_string(event_payload, '$.k')::bigint END AS k
       FROM {ride_events} WHERE json_valid(event_payload)""",
)
def _(d):
    path = run_dir(d.spark, "documents")
    docs = d.table("ride_events").select(
        F.col("event_id").alias("_id"), "ride_id", "event_type", F.col("occurred_at").alias("event_time"), F.parse_json(F.when(F.try_parse_json("event_payload").isNotNull(), F.col("event_payload"))).alias("payload")
    )
    # Documents with a broken payload are broken lines of the export; the reader tells them from the others.
    text = F.to_json(F.struct(*docs.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    docs.select(F.when(F.col("payload").isNotNull(), text).otherwise(F.substring(text, 1, 20)).alias("value")).write.text(path)
    read = readers.scan_documents(d.spark, path, DOCUMENT, unreadable="raw")
    return read.filter("raw IS NULL").select("_id", "ride_id", "event_type", "event_time", "payload.k")


@query("scan_warehouse", "SELECT zone_code, count(*) AS rides FROM {rides} r JOIN {zones} z ON z.zone_id = r.pickup_zone_id GROUP BY ALL")
def _(d):
    names = {}
    for table in ("rides", "zones"):
        names[table] = f"fm_{table}_{uuid.uuid4().hex[:8]}"
        sinks.materialize_table(d.spark, d.table(table), names[table], run_dir(d.spark, "warehouse"))
    rides, zones = (readers.scan_warehouse(d.spark, names[t]) for t in ("rides", "zones"))
    return rides.join(zones, rides.pickup_zone_id == zones.zone_id).groupBy("zone_code").agg(F.count("*").alias("rides"))


@query("scan_landing", "SELECT lsn, status, CASE WHEN lsn % 2 = 1 THEN lsn * 10 END AS extra FROM {change_log}")
def _(d):
    # Files of two schema versions under one prefix; an empty prefix gives nothing to load.
    path = run_dir(d.spark, "prefix")
    log = d.table("change_log").select("lsn", "status")
    log.filter("lsn % 2 = 0").write.parquet(f"{path}/hour=00")
    log.filter("lsn % 2 = 1").withColumn("extra", F.col("lsn") * 10).write.parquet(f"{path}/hour=01")
    if readers.scan_landing(d.spark, run_dir(d.spark, "empty")) is not None:
        raise RuntimeError("an empty prefix must be skipped")
    return readers.scan_landing(d.spark, path).select("lsn", "status", "extra")


@query("scan_federated", "SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS already_loaded FROM orders")
def _(d):
    # The warehouse side is a written table, the extract the raw files.
    path = run_dir(d.spark, "loaded")
    d.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().write.parquet(path)
    return readers.scan_federated(d.table("orders").select("o_orderkey"), d.spark.read.parquet(path), "o_orderkey")


@query("scan_seed_csv", "SELECT DISTINCT cancellation_reason AS reason, length(cancellation_reason)::int AS weight FROM {rides} WHERE cancellation_reason IS NOT NULL")
def _(d):
    path = run_dir(d.spark, "seed")
    reasons = d.table("rides").filter("cancellation_reason IS NOT NULL").select(F.col("cancellation_reason").alias("reason"), F.length("cancellation_reason").alias("weight")).distinct()
    reasons.write.option("header", True).csv(path)
    return readers.scan_seed_csv(d.spark, path, T.StructType([T.StructField("reason", T.StringType()), T.StructField("weight", T.IntegerType())]))


@query("mart_refresh_stamp", "SELECT TIMESTAMP '2026-06-01 00:00:00' AS refreshed_at, count(*) AS rows FROM (SELECT DISTINCT requested_date, time_bucket, pickup_zone_code, pickup_zone_name, pickup_city, vehicle_type_code FROM {o_rides} WHERE ride_status = 'COMPLETED') GROUP BY ALL")
def _(d):
    return marts.mart_surge_analysis(d.rides, now("2026-06-01 00:00:00")).groupBy("refreshed_at").agg(F.count("*").alias("rows"))
