"""Ingest projections, filters, dedup, merges, history."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from fleetmart.functions import domain
from fleetmart.functions.keys import integer_key
from fleetmart.operators import dedup, history, ingest, merge
from fleetmart.operators.sequence import row_slices, with_neighbour
from fleetmart.plans import rules
from fleetmart.sources.contracts import SPECS
from registry.core import CTES, NOW, SNAPSHOT_NOW, now, query, today

# Projections ---------------------------------------------------------------------------------------------------------

EVENT_SPEC = SPECS["ride_events"]
JKT = "INTERVAL 7 HOUR"


@query("select_declared_columns", "SELECT ride_id, driver_id, total_fare::double AS total_fare FROM {rides}")
def _(d):
    names = ingest.parse_columns("ride_id, driver_id,\n total_fare,,", SPECS["rides"].types)
    return d.table("rides").select(*names)


@query(
    "cast_to_contract",
    f"""SELECT 'E-' || event_id::varchar AS event_id, 'R-' || user_id::varchar AS ride_id, event_type, props AS event_payload,
        ts - {JKT} AS occurred_at FROM {{events}}""",
)
def _(d):
    # The raw extract has naive local timestamps, so they are read in the source's zone.
    raw = d.table("events").select(
        F.concat(F.lit("E-"), "event_id").alias("event_id"), F.concat(F.lit("R-"), "user_id").alias("ride_id"),
        "event_type", F.col("props").alias("event_payload"), F.col("ts").alias("occurred_at"),
    )
    return ingest.cast_to_contract(raw, EVENT_SPEC)


@query("normalise_timestamp", f"SELECT event_id, ts - {JKT} AS at FROM {{events}}")
def _(d):
    return d.table("events").select("event_id", ingest.normalise_timestamp(d.table("events"), "ts").alias("at"))


@query("json_to_string", """SELECT event_id, '{"user":' || user_id::varchar || ',"type":"' || event_type || '"}' AS doc FROM events""")
def _(d):
    nested = d.table("events").select("event_id", F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")).alias("doc"))
    return nested.select("event_id", ingest.json_to_string(nested, "doc").alias("doc"))


@query("add_ingest_metadata", f"SELECT ride_id, TIMESTAMP '{NOW}' AS _ingested_at, 'ride_ops_pg' AS _source_system FROM {{rides}}")
def _(d):
    return ingest.add_ingest_metadata(d.table("rides").select("ride_id"), "ride_ops_pg", now())


@query("coalesce_source_system", "SELECT ride_id, ifnull(_source_system, 'postgres') AS _source_system FROM {rides}")
def _(d):
    return ingest.coalesce_source_system(d.table("rides").select("ride_id", "_source_system"))


@query("drop_columns", "SELECT * EXCLUDE (l_comment_rank) FROM (SELECT l_orderkey, l_partkey, l_suppkey, 1 AS l_comment_rank FROM lineitem)")
def _(d):
    return d.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.lit(1).alias("rank")).drop("rank")


@query("star_expand", "SELECT * FROM (SELECT passenger_id, gender, status FROM {passengers}) WHERE status = 'ACTIVE'")
def _(d):
    staged = d.table("passengers").select("passenger_id", "gender", "status")
    return staged.filter("status = 'ACTIVE'").select("*")


# Filters -------------------------------------------------------------------------------------------------------------


@query(
    "window_filter",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 07:00:00' AND ts < TIMESTAMP '2024-01-12 07:00:00'",
)
def _(d):
    out = ingest.window_filter(d.table("events"), "ts", "2024-01-05T00:00:00", "2024-01-12T00:00:00")
    return out.select("event_id", F.col("ts").cast("timestamp").alias("ts"))


@query("window_override", "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-12 07:00:00'")
def _(d):
    out = ingest.window_filter(d.table("events"), "ts", "2024-01-05T00:00:00", "2024-01-12T00:00:00", window_start="2024-01-06 00:00:00")
    return out.agg(F.count("*").alias("n"))


@query("incremental_lookback", f"SELECT ride_id, updated_at FROM {{rides}} WHERE updated_at >= TIMESTAMP '{NOW}' - INTERVAL 3 DAY")
def _(d):
    return ingest.incremental_lookback(d.table("rides"), "updated_at", now(), 3).select("ride_id", "updated_at")


@query("active_only", "SELECT zone_id, zone_code FROM {zones} WHERE is_active")
def _(d):
    return d.table("zones").filter(F.col("is_active")).select("zone_id", "zone_code")


@query("current_version", "SELECT driver_id, updated_at AS valid_from FROM {drivers}")
def _(d):
    return history.scd2_current(d.driver_history).filter("is_current").select("driver_id", "valid_from")


@query(
    "status_in",
    "SELECT upper(ride_status) AS ride_status, count(*) AS rides FROM {rides} WHERE upper(ride_status) IN ('COMPLETED', 'CANCELLED') AND driver_id IS NOT NULL GROUP BY ALL",
)
def _(d):
    status = F.upper("ride_status")
    kept = d.table("rides").filter(status.isin("COMPLETED", "CANCELLED") & F.col("driver_id").isNotNull())
    return kept.groupBy(status.alias("ride_status")).agg(F.count("*").alias("rides"))


@query("recent_days", f"SELECT ride_id FROM {{rides}} WHERE requested_at::date >= DATE '{NOW[:10]}' - 90")
def _(d):
    dated = d.table("rides").select("ride_id", F.to_date("requested_at").alias("requested_date"))
    return ingest.recent_days(dated, "requested_date", today(), 90).select("ride_id")


@query("not_in_terminal", "SELECT ride_id, ride_status FROM {rides} WHERE upper(ride_status) NOT IN ('COMPLETED', 'CANCELLED', 'NO_DRIVER')")
def _(d):
    return rules.not_terminal(d.table("rides")).select("ride_id", "ride_status")


@query("between_buckets", "SELECT count(*) AS rides FROM {rides} WHERE hour(requested_at) BETWEEN 7 AND 9")
def _(d):
    return d.table("rides").filter(F.hour("requested_at").between(7, 9)).agg(F.count("*").alias("rides"))


@query("like_prefix", "SELECT count(*) AS rides FROM {o_rides} WHERE pickup_zone_code LIKE 'JKT-%'")
def _(d):
    return d.rides.filter(F.col("pickup_zone_code").like("JKT-%")).agg(F.count("*").alias("rides"))


@query("regex_match", "SELECT count(*) AS passengers FROM {o_passengers} WHERE regexp_full_match(phone_number, '08[0-9]{8,11}')")
def _(d):
    return d.passengers.filter(F.col("phone_number").rlike("^08[0-9]{8,11}$")).agg(F.count("*").alias("passengers"))


# Dedup ---------------------------------------------------------------------------------------------------------------

LINE = "l_orderkey, l_linenumber"
TIES = "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"


@query(
    "latest_per_key",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT {LINE}, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
        row_number() OVER (PARTITION BY {LINE} ORDER BY l_shipdate DESC, {TIES}) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(d):
    out = dedup.latest_per_key(d.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"))


@query(
    "latest_per_key_multi",
    """SELECT * EXCLUDE (rn) FROM (SELECT passenger_id, ride_id, updated_at, created_at, requested_at,
       row_number() OVER (PARTITION BY passenger_id ORDER BY updated_at DESC, created_at DESC, requested_at DESC, ride_id DESC) AS rn FROM {rides}) WHERE rn = 1""",
)
def _(d):
    rides = d.table("rides").select("passenger_id", "ride_id", "updated_at", "created_at", "requested_at")
    return dedup.latest_per_key(rides, ["passenger_id"], ["updated_at", "created_at", "requested_at"], ["ride_id"])


@query("row_number", f"SELECT * EXCLUDE (rn) FROM (SELECT {LINE}, l_partkey, l_suppkey, row_number() OVER (PARTITION BY {LINE} ORDER BY l_quantity, {TIES}) AS rn FROM lineitem) WHERE rn = 1")
def _(d):
    from pyspark.sql import Window

    ties = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    order = [F.col("l_quantity").asc(), *[F.col(c).desc() for c in ties]]
    rank = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*order))
    return d.table("lineitem").withColumn("rn", rank).filter("rn = 1").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# Three extracts of the customer table: later ones change status and time of some rows and miss others. ---------------

CTES["batch0"] = """SELECT c_custkey AS id, c_mktsegment AS status, 'v0' AS tag, cast('2026-01-01 00:00:00' AS timestamp) AS updated_at,
 DATE '2026-01-01' + (c_custkey % 28)::int AS day FROM customer"""
CTES["batch1"] = """SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 1 THEN 'MOVED' ELSE c_mktsegment END AS status, 'v1' AS tag,
 cast('2026-01-01 00:00:00' AS timestamp) + (CASE WHEN c_custkey % 7 = 1 THEN INTERVAL 1 DAY WHEN c_custkey % 7 = 3 THEN INTERVAL '-1' DAY ELSE INTERVAL 0 DAY END) AS updated_at,
 DATE '2026-01-01' + ((c_custkey + CASE WHEN c_custkey % 7 = 1 THEN 5 ELSE 0 END) % 28)::int AS day FROM customer WHERE c_custkey % 101 <> 1
 UNION ALL SELECT -c_custkey - 1, 'NEW', 'v1', cast('2026-01-02 00:00:00' AS timestamp), DATE '2026-02-01' FROM customer WHERE c_custkey % 50 = 0"""
CTES["batch2"] = """SELECT c_custkey AS id, CASE WHEN c_custkey % 7 IN (1, 2) THEN c_mktsegment ELSE 'X' END AS status, 'v2' AS tag,
 cast('2026-01-01 00:00:00' AS timestamp) + (CASE WHEN c_custkey % 7 IN (1, 2) THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END) AS updated_at,
 DATE '2026-01-01' + (c_custkey % 28)::int AS day FROM customer WHERE c_custkey % 101 <> 2"""


def batches(d):
    """The same three extracts as DataFrames."""
    c = d.table("customer").withColumnRenamed("c_custkey", "id")
    start, key = now("2026-01-01 00:00:00"), F.col("id")
    day = lambda shift: F.date_add(F.lit("2026-01-01").cast("date"), ((key + shift) % 28).cast("int"))
    span = lambda days: F.make_dt_interval(days=days)
    shape = lambda df, status, tag, at, when: df.select("id", status.alias("status"), F.lit(tag).alias("tag"), at.alias("updated_at"), when.alias("day"))
    seg = F.col("c_mktsegment")
    moved = key % 7 == 1
    b0 = shape(c, seg, "v0", start, day(0))
    shift1 = F.when(moved, 1).when(key % 7 == 3, -1).otherwise(0)
    b1 = shape(c.filter(key % 101 != 1), F.when(moved, "MOVED").otherwise(seg), "v1", start + span(shift1), day(F.when(moved, 5).otherwise(0)))
    extra = c.filter(key % 50 == 0).select(
        (-key - 1).alias("id"), F.lit("NEW").alias("status"), F.lit("v1").alias("tag"),
        now("2026-01-02 00:00:00").alias("updated_at"), F.lit("2026-02-01").cast("date").alias("day"),
    )
    late = (key % 7).isin(1, 2)
    b2 = shape(c.filter(key % 101 != 2), F.when(late, seg).otherwise("X"), "v2", start + span(F.when(late, 3).otherwise(0)), day(0))
    return b0, b1.unionByName(extra), b2


CTES["newer1"] = """SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.status ELSE t.status END AS status,
 CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.tag ELSE t.tag END AS tag,
 CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END AS updated_at,
 CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.day ELSE t.day END AS day
 FROM {batch0} t FULL JOIN {batch1} s ON s.id = t.id"""
NEWER2 = """SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.status ELSE t.status END AS status,
 CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.tag ELSE t.tag END AS tag,
 CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END AS updated_at,
 CASE WHEN t.id IS NULL OR s.updated_at > t.updated_at THEN s.day ELSE t.day END AS day
 FROM {newer1} t FULL JOIN {batch2} s ON s.id = t.id"""


@query("merge_if_newer", NEWER2)
def _(d):
    b0, b1, b2 = batches(d)
    return merge.merge_if_newer(merge.merge_if_newer(b0, b1, ["id"], ["updated_at"]), b2, ["id"], ["updated_at"])


@query("merge_overwrite", "SELECT * FROM {batch1} UNION ALL SELECT * FROM {batch0} WHERE id NOT IN (SELECT id FROM {batch1})")
def _(d):
    b0, b1, _ = batches(d)
    return merge.merge_overwrite(b0, b1, ["id"])


@query("merge_append_only", "SELECT * FROM {batch0} UNION ALL SELECT * FROM {batch1} WHERE id NOT IN (SELECT id FROM {batch0})")
def _(d):
    b0, b1, _ = batches(d)
    return b0.unionByName(merge.merge_append_only(b0, b1, ["id"]))


@query("merge_delete_missing", "SELECT * FROM {batch0} WHERE id IN (SELECT id FROM {batch1})")
def _(d):
    b0, b1, _ = batches(d)
    return merge.merge_delete_missing(b0, b1, ["id"])


@query("incremental_merge", "SELECT * FROM {batch2} UNION ALL SELECT * FROM {batch0} WHERE id NOT IN (SELECT id FROM {batch2})")
def _(d):
    b0, _, b2 = batches(d)
    return merge.incremental_merge(b0, b2, ["id"])


@query(
    "evolve_schema",
    """SELECT coalesce(s.id, t.id) AS id, coalesce(s.status, t.status) AS status, s.score AS score FROM
       (SELECT id, status FROM {batch0}) t FULL JOIN (SELECT id, status, id * 2 AS score FROM {batch1}) s ON s.id = t.id""",
)
def _(d):
    b0, b1, _ = batches(d)
    old, incoming = b0.select("id", "status"), b1.select("id", "status", (F.col("id") * 2).alias("score"))
    widened, report = merge.evolve_schema(old, incoming)
    if report != "added:score":
        raise ValueError(report)
    return merge.merge_overwrite(widened, incoming, ["id"])


@query(
    "ingest_table",
    f"""SELECT 'E-' || event_id::varchar AS event_id, 'R-' || user_id::varchar AS ride_id, event_type, props AS event_payload,
        ts - {JKT} AS occurred_at, TIMESTAMP '{SNAPSHOT_NOW}' AS _ingested_at, 'ride_ops_pg' AS _source_system
        FROM events WHERE ts >= TIMESTAMP '2024-01-05 07:00:00' AND ts < TIMESTAMP '2024-01-20 07:00:00'""",
)
def _(d):
    # Two overlapping windows of the raw event extract; the second run appends only keys the first lacks.
    raw = d.table("events").select(
        F.concat(F.lit("E-"), "event_id").alias("event_id"), F.concat(F.lit("R-"), "user_id").alias("ride_id"),
        "event_type", F.col("props").alias("event_payload"), F.col("ts").alias("occurred_at"),
    )
    first = ingest.ingest_table(EVENT_SPEC, raw, None, "2024-01-05T00:00:00", "2024-01-12T00:00:00", now(SNAPSHOT_NOW))
    return ingest.ingest_table(EVENT_SPEC, raw, first, "2024-01-10T00:00:00", "2024-01-20T00:00:00", now(SNAPSHOT_NOW))


# Upserts of whole tables: two runs over overlapping windows, the second on rows that have changed since and with a column more.
FIRST_RUN, SECOND_RUN = "2026-05-01 00:00:00", SNAPSHOT_NOW
RUNS = {
    # table: key, column that changes, window ends, columns shown
    "rides": ("ride_id", "notes", ("1992-01-01", "1996-01-01", "1995-06-01", "2010-01-01"), ["total_fare"]),
    "drivers": ("driver_id", "vehicle_color", ("2026-01-01", "2026-03-01", "2026-02-01", "2027-01-01"), ["rating"]),
    "payments": ("payment_id", "currency", ("1992-01-01", "1996-01-01", "1995-06-01", "2010-01-01"), ["amount"]),
}


def upsert_sql(table: str) -> str:
    key, changing, (a, b, c, e), shown = RUNS[table]
    number = f"cast(regexp_extract({key}, '([0-9]+)$', 1) AS bigint)"
    later = f"updated_at + CASE WHEN {number} % 3 = 0 THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END"
    taken = lambda column: f"CASE WHEN t.{key} IS NULL OR s.updated_at > t.updated_at THEN s.{column} ELSE t.{column} END AS {column}"
    doubles = ", ".join(f"{x}::double AS {x}" for x in shown)
    return f"""WITH old AS (SELECT {key}, {changing}, {doubles}, updated_at, NULL::varchar AS channel, TIMESTAMP '{FIRST_RUN}' AS _ingested_at FROM {{{table}}} WHERE updated_at >= '{a}' AND updated_at < '{b}'),
 fresh AS (SELECT {key}, CASE WHEN {number} % 3 = 0 THEN 'changed' ELSE {changing} END AS {changing}, {doubles}, {later} AS updated_at, 'app' AS channel, TIMESTAMP '{SECOND_RUN}' AS _ingested_at
   FROM {{{table}}} WHERE {later} >= '{c}' AND {later} < '{e}')
 SELECT coalesce(s.{key}, t.{key}) AS {key}, {', '.join(taken(x) for x in [changing, *shown, 'updated_at', 'channel', '_ingested_at'])} FROM old t FULL JOIN fresh s ON s.{key} = t.{key}"""


def upsert(d, table):
    key, changing, (a, b, c, e), shown = RUNS[table]
    spec = SPECS[table]
    wider = replace(spec, declared=spec.declared + ", channel STRING")
    rows = d.table(table)
    rows = rows.withColumns({name: F.lit(None).cast("string") for name in spec.types if name not in rows.columns})
    turn = F.regexp_extract(key, "([0-9]+)$", 1).cast("long") % 3 == 0
    later = F.when(turn, F.col("updated_at") + F.expr("INTERVAL 400 DAY")).otherwise(F.col("updated_at"))
    changed = rows.withColumns({changing: F.when(turn, "changed").otherwise(F.col(changing)), "updated_at": later, "channel": F.lit("app")})
    first = ingest.ingest_table(spec, rows, None, a, b, now(FIRST_RUN))
    return ingest.ingest_table(wider, changed, first, c, e, now(SECOND_RUN)).select(key, changing, *shown, "updated_at", "channel", "_ingested_at")


@query("ingest_rides", upsert_sql("rides"))
def _(d):
    return upsert(d, "rides")


@query("ingest_drivers", upsert_sql("drivers"))
def _(d):
    return upsert(d, "drivers")


@query("ingest_payments", upsert_sql("payments"))
def _(d):
    return upsert(d, "payments")


USAGE_KEY = "('0x' || substr(md5(usage_id), 1, 15))::bigint"


@query(
    "ingest_promo_usage",
    f"""SELECT {USAGE_KEY} AS usage_id, promo_id, ride_id, discount_given::double AS discount_given, used_at,
        CASE WHEN used_at < '1996-01-01' THEN TIMESTAMP '{FIRST_RUN}' ELSE TIMESTAMP '{SECOND_RUN}' END AS _ingested_at FROM {{promo_usage}} WHERE used_at >= '1992-01-01' AND used_at < '2010-01-01'""",
)
def _(d):
    spec = SPECS["promo_usage"]
    rows = d.table("promo_usage").withColumn("usage_id", integer_key(F.col("usage_id")))
    first = ingest.ingest_table(spec, rows, None, "1992-01-01", "1996-01-01", now(FIRST_RUN))
    # The log never changes: what the second window finds again is left alone.
    later = rows.withColumn("discount_given", F.when(F.col("used_at") < "1996-01-01", F.lit(-1).cast("decimal(12,2)")).otherwise(F.col("discount_given")))
    both = ingest.ingest_table(spec, later, first, "1995-06-01", "2010-01-01", now(SECOND_RUN))
    return both.select("usage_id", "promo_id", "ride_id", "discount_given", "used_at", "_ingested_at")


# History -------------------------------------------------------------------------------------------------------------

CTES["o_history"] = f"""
WITH seen AS (
  SELECT b0.id, b0.status, b0.updated_at AS f0, CASE WHEN b1.updated_at > b0.updated_at THEN b1.updated_at END AS f1, b1.status AS s1,
         b1.id IS NULL AS gone1, b2.updated_at AS u2, b2.status AS s2, b2.id IS NULL AS gone2
  FROM {{batch0}} b0 LEFT JOIN {{batch1}} b1 ON b1.id = b0.id LEFT JOIN {{batch2}} b2 ON b2.id = b0.id
), versions AS (
  SELECT id, status, f0 AS valid_from,
         CASE WHEN gone1 THEN TIMESTAMP '2026-02-01' WHEN f1 IS NOT NULL THEN f1 WHEN gone2 THEN TIMESTAMP '2026-03-01'
              WHEN u2 > f0 THEN u2 END AS valid_to FROM seen
  UNION ALL
  SELECT id, s1, f1, CASE WHEN gone2 THEN TIMESTAMP '2026-03-01' WHEN u2 > f1 THEN u2 END FROM seen WHERE f1 IS NOT NULL
  UNION ALL
  SELECT id, s2, u2, NULL FROM seen WHERE NOT gone2 AND (gone1 OR u2 > coalesce(f1, f0))
  UNION ALL
  SELECT id, status, updated_at, TIMESTAMP '2026-03-01' FROM {{batch1}} WHERE id < 0
)
SELECT id, status, valid_from, valid_to FROM versions
"""


def driver_log(d):
    """History of the customer extracts after three snapshots."""
    out = None
    for batch, at in zip(batches(d), ("2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00")):
        out = history.scd2_snapshot(out, batch.select("id", "status", "updated_at"), "id", "updated_at", now(at))
    return out


@query("scd2_snapshot", "SELECT * FROM {o_history}")
def _(d):
    return driver_log(d).select("id", "status", "valid_from", "valid_to")


@query("scd2_hard_delete", "SELECT id, valid_to FROM {o_history} WHERE valid_to IN (TIMESTAMP '2026-02-01', TIMESTAMP '2026-03-01')")
def _(d):
    runs = [now("2026-02-01 00:00:00"), now("2026-03-01 00:00:00")]
    return driver_log(d).filter(F.col("valid_to").isin(*runs)).select("id", "valid_to")


@query("scd2_current", "SELECT id, status, valid_from, valid_to, true AS is_current FROM {o_history} WHERE valid_to IS NULL")
def _(d):
    return history.scd2_current(driver_log(d)).select("id", "status", "valid_from", "valid_to", "is_current")


@query(
    "scd2_as_of",
    "SELECT id, status FROM {o_history} WHERE valid_from <= TIMESTAMP '2026-01-02 12:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2026-01-02 12:00:00')",
)
def _(d):
    return history.scd2_as_of(driver_log(d), now("2026-01-02 12:00:00")).select("id", "status")


@query(
    "scd2_as_of_each",
    """SELECT p.o_orderkey, h.status FROM (SELECT o_orderkey, o_custkey AS id, TIMESTAMP '2026-01-01' + INTERVAL 1 HOUR * (o_orderkey % 2000) AS at FROM orders) p
       JOIN {o_history} h ON h.id = p.id AND h.valid_from <= p.at AND (h.valid_to IS NULL OR p.at < h.valid_to)""",
)
def _(d):
    probes = d.table("orders").select(
        "o_orderkey", F.col("o_custkey").alias("id"),
        (now("2026-01-01 00:00:00") + F.make_dt_interval(hours=(F.col("o_orderkey") % 2000).cast("int"))).alias("at"),
    )
    # Slices of about 4,000 rows, so that versions are carried over their edges at every scale.
    return history.scd2_as_of_each(driver_log(d).select("id", "status", "valid_from", "valid_to"), probes, "id", "at", 4000).select("o_orderkey", "status")


CTES["o_versions"] = """SELECT customer_id, status, ts AS valid_from, lsn, op,
 lead(ts) OVER (PARTITION BY customer_id ORDER BY ts, lsn) AS valid_to FROM {change_log}"""


@query("scd2_from_changes", "SELECT customer_id, status, valid_from, valid_to, valid_to IS NULL AS is_current FROM {o_versions} WHERE op <> 'd'")
def _(d):
    out = history.scd2_from_changes(d.table("change_log"), "customer_id")
    return out.select("customer_id", "status", "valid_from", "valid_to", "is_current")


CTES["o_steps"] = """SELECT *, lag(status) OVER (PARTITION BY customer_id ORDER BY valid_from) AS before FROM {o_versions} WHERE op <> 'd'"""


@query(
    "scd2_transitions",
    """SELECT before AS from_value, status AS to_value, count(*) AS transitions, count(DISTINCT customer_id) AS entities FROM {o_steps}
       WHERE before <> status AND valid_from >= TIMESTAMP '1997-01-01' AND valid_from < TIMESTAMP '1999-01-01' GROUP BY ALL""",
)
def _(d):
    versions = history.scd2_from_changes(d.table("change_log"), "customer_id")
    return history.scd2_transitions(versions, "customer_id", "status", now("1997-01-01 00:00:00"), now("1999-01-01 00:00:00"))


@query("changed_more_than_once", "SELECT customer_id, count(*) AS changes FROM {o_steps} WHERE before <> status GROUP BY ALL HAVING count(*) > 1")
def _(d):
    versions = history.scd2_from_changes(d.table("change_log"), "customer_id")
    return history.changed_more_than_once(versions, "customer_id", "status")


@query("first_time", "SELECT customer_id, min(valid_from) AS first_at FROM {o_versions} WHERE op <> 'd' AND status = 'F' GROUP BY ALL")
def _(d):
    versions = history.scd2_from_changes(d.table("change_log"), "customer_id")
    return history.first_time(versions, "customer_id", F.col("status") == "F")


@query("version_chaining", "SELECT customer_id, lsn, lag(lsn) OVER (PARTITION BY customer_id ORDER BY ts, lsn) AS previous_lsn, lead(lsn) OVER (PARTITION BY customer_id ORDER BY ts, lsn) AS next_lsn FROM {change_log}")
def _(d):
    # A slice has about 5,000 rows whatever their dates and keys are.
    cut = row_slices(d.table("change_log"), "ts", 5000)
    chained = with_neighbour(d.table("change_log"), ["customer_id"], ["ts", "lsn"], {"next_lsn": "lsn"}, cut)
    chained = with_neighbour(chained, ["customer_id"], ["ts", "lsn"], {"previous_lsn": "lsn"}, cut, previous=True)
    return chained.select("customer_id", "lsn", "previous_lsn", "next_lsn")


@query(
    "high_water_mark",
    "SELECT greatest(max(updated_at), max(created_at), max(requested_at)) AS high_water_mark FROM {rides}",
)
def _(d):
    return history.high_water_mark(d.table("rides"), ["updated_at", "created_at", "requested_at"], now("1990-01-01 00:00:00"))


@query("statuses_known", "SELECT upper(ride_status) AS ride_status, count(*) AS rides FROM {rides} GROUP BY ALL")
def _(d):
    status = F.upper("ride_status")
    return d.table("rides").filter(status.isin(domain.RIDE_STATUSES)).groupBy(status.alias("ride_status")).agg(F.count("*").alias("rides"))
