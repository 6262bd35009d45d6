"""Data-quality checks and business rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions import domain
from fleetmart.operators import checked, quality
from fleetmart.plans import marts, rules
from fleetmart.session import run_dir
from registry.core import CTES, NOW, SNAPSHOT_NOW, now, query, r

BAD_FARE = """(ride_status = 'COMPLETED' AND total_fare <= 0) OR least(base_fare, distance_fare, time_fare, total_fare) < 0
 OR (ride_status = 'CANCELLED' AND total_fare > 0)"""
BAD_ORDER = "coalesce(accepted_at < requested_at, false) OR coalesce(picked_up_at < accepted_at, false) OR coalesce(completed_at < picked_up_at, false)"


@query(
    "dq_fare_consistency",
    f"""SELECT ride_id, ride_status, base_fare::double AS base_fare, distance_fare::double AS distance_fare, time_fare::double AS time_fare,
        total_fare::double AS total_fare FROM {{o_rides}} WHERE {BAD_FARE}""",
)
def _(d):
    return quality.dq_fare_consistency(d.rides)


@query("dq_timestamp_order", f"SELECT ride_id, ride_code, ride_status, requested_at, accepted_at, picked_up_at, completed_at FROM {{o_rides}} WHERE {BAD_ORDER}")
def _(d):
    return quality.dq_timestamp_order(d.rides)


@query("dq_phone_canonical", "SELECT phone_number FROM {o_passengers} WHERE NOT regexp_full_match(phone_number, '08[0-9]{8,11}')")
def _(d):
    return quality.dq_phone_canonical(d.passengers, "phone_number")


@query("dq_unique", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(d):
    return quality.dq_unique(d.table("lineitem"), "l_orderkey")


@query("dq_not_null", "SELECT ride_id, ride_status FROM {o_rides} WHERE driver_id IS NULL")
def _(d):
    return quality.dq_not_null(d.rides, "driver_id").select("ride_id", "ride_status")


@query("dq_accepted_values", "SELECT gender, count(*) AS n FROM {passengers} WHERE gender NOT IN ('M', 'F', 'OTHER', 'UNKNOWN') GROUP BY ALL")
def _(d):
    return quality.dq_accepted_values(d.table("passengers"), "gender", ["M", "F", "OTHER", "UNKNOWN"])


@query("dq_accepted_range", "SELECT driver_id, rating::double AS rating FROM {drivers} WHERE rating < 1 OR rating > 5")
def _(d):
    return quality.dq_accepted_range(d.table("drivers"), "rating", 1, 5).select("driver_id", "rating")


FRESH_SQL = """SELECT '{t}' AS table_name, max({c}) AS max_loaded_at, date_sub('second', max({c}), TIMESTAMP '{now}')::double / 3600.0::double AS age_hours,
 CASE WHEN max({c}) IS NULL OR date_sub('second', max({c}), TIMESTAMP '{now}') > {e} * 3600 THEN 'error'
      WHEN date_sub('second', max({c}), TIMESTAMP '{now}') > {w} * 3600 THEN 'warn' ELSE 'pass' END AS status FROM [{t}]"""


def fresh_sql(t, c, at, w, e):
    return FRESH_SQL.replace("{t}", t).replace("{c}", c).replace("{now}", at).replace("{w}", str(w)).replace("{e}", str(e)).replace("[", "{").replace("]", "}")


@query(
    "dq_freshness",
    fresh_sql("rides", "updated_at", NOW, 2, 6) + " UNION ALL " + fresh_sql("ride_events", "occurred_at", "2024-01-31 01:00:00", 2, 6)
    + " UNION ALL " + fresh_sql("zones", "created_at", SNAPSHOT_NOW, 24, 72),
)
def _(d):
    return (
        quality.dq_freshness(d.table("rides"), "rides", "updated_at", now())
        .unionByName(quality.dq_freshness(d.table("ride_events"), "ride_events", "occurred_at", now("2024-01-31 01:00:00")))
        .unionByName(quality.dq_freshness(d.table("zones"), "zones", "created_at", now(SNAPSHOT_NOW), quality.LOOKUP_FRESHNESS_HOURS))
    )


STATUS_LIST = "('REQUESTED', 'ACCEPTED', 'PICKED_UP', 'COMPLETED', 'CANCELLED', 'NO_DRIVER')"
REPORT_LINES = [
    ("not_null", "passenger_id", "passenger_id IS NULL"),
    ("not_null", "driver_id", "driver_id IS NULL"),
    ("accepted_values", "ride_status", f"ride_status NOT IN {STATUS_LIST}"),
    ("accepted_values", "time_bucket", "time_bucket NOT IN ('morning_peak', 'evening_peak', 'late_night', 'off_peak')"),
    ("accepted_range", "total_fare", "total_fare < 0"),
    ("accepted_range", "surge_multiplier", "surge_multiplier < 1 OR surge_multiplier > 5"),
    ("accepted_range", "distance_km", "distance_km < 0"),
    ("fare_consistency", "total_fare", BAD_FARE),
    ("timestamp_order", "requested_at", BAD_ORDER),
]
REPORT_SQL = (
    "SELECT 'fct_rides' AS table_name, check_name, column_name, failing, failing = 0 AS passed FROM ("
    + " UNION ALL ".join(f"SELECT '{a}' AS check_name, '{b}' AS column_name, count(*) FILTER ({c}) AS failing FROM {{o_rides}}" for a, b, c in REPORT_LINES)
    + "".join(
        f" UNION ALL SELECT 'unique', '{c}', count(*) FROM (SELECT {c} FROM {{o_rides}} GROUP BY {c} HAVING count(*) > 1)" for c in ("ride_id", "ride_code")
    )
    + ")"
)


@query("dq_report", REPORT_SQL)
def _(d):
    row_rules = [
        quality.not_null("passenger_id"),
        quality.not_null("driver_id"),
        quality.accepted_values("ride_status", domain.RIDE_STATUSES),
        quality.accepted_values("time_bucket", ["morning_peak", "evening_peak", "late_night", "off_peak"]),
        quality.accepted_range("total_fare", low=0),
        quality.accepted_range("surge_multiplier", 1, 5),
        quality.accepted_range("distance_km", low=0),
        quality.Rule("fare_consistency", "total_fare", quality.fare_is_inconsistent()),
        quality.Rule("timestamp_order", "requested_at", quality.timestamps_are_disordered()),
    ]
    # What the checks read of the fact is stored once, so its joins run once for row rules and uniqueness.
    read = ["ride_id", "ride_code", "passenger_id", "driver_id", "ride_status", "time_bucket", "surge_multiplier", "distance_km", "base_fare", "distance_fare", "time_fare", "total_fare"]
    read += ["requested_at", "accepted_at", "picked_up_at", "completed_at"]
    return quality.dq_report(d.stored("fct_rides", d.rides.select(*read)), "fct_rides", row_rules, ["ride_id", "ride_code"])


# Declared checks by table: what must hold of each column.
NOT_NULL, UNIQUE = "not_null", "unique"
SUITES = {
    "zones": [(UNIQUE, "zone_id"), (NOT_NULL, "zone_id"), (UNIQUE, "zone_code"), (NOT_NULL, "zone_code"), (NOT_NULL, "zone_name")],
    "vehicle_types": [
        (UNIQUE, "vehicle_type_id"), (NOT_NULL, "vehicle_type_id"), (UNIQUE, "type_code"), (NOT_NULL, "type_code"),
        ("accepted_values", "type_code", ["MOTOR", "ECONOMI", "COMFORT", "SUV", "PREMIUM"]),
    ],
    "drivers": [
        (UNIQUE, "driver_id"), (NOT_NULL, "driver_id"), (UNIQUE, "driver_code"), (NOT_NULL, "driver_code"), ("accepted_values", "status", ["ACTIVE", "INACTIVE", "SUSPENDED", "PENDING"]),
    ],
    "passengers": [
        (UNIQUE, "passenger_id"), (NOT_NULL, "passenger_id"), (UNIQUE, "passenger_code"), (NOT_NULL, "passenger_code"), ("accepted_values", "gender", ["M", "F", "OTHER", "UNKNOWN"]),
        ("accepted_values", "status", ["ACTIVE", "INACTIVE", "BANNED"]),
    ],
    "rides": [
        (UNIQUE, "ride_id"), (NOT_NULL, "ride_id"), (UNIQUE, "ride_code"), (NOT_NULL, "ride_code"), (NOT_NULL, "passenger_id"), (NOT_NULL, "requested_at"),
        ("accepted_values", "ride_status", domain.RIDE_STATUSES), ("accepted_range", "total_fare", 0, None), ("accepted_range", "distance_km", 0, None),
    ],
    "ride_events": [(UNIQUE, "event_id"), (NOT_NULL, "event_id"), (NOT_NULL, "ride_id"), (NOT_NULL, "occurred_at"), ("accepted_values", "event_type", domain.EVENT_TYPES)],
    "payments": [(UNIQUE, "payment_id"), (NOT_NULL, "payment_id"), (NOT_NULL, "ride_id"), ("accepted_values", "payment_status", ["SUCCESS", "FAILED", "PENDING"]), ("accepted_range", "amount", 0, None)],
    "promo_usage": [(UNIQUE, "usage_id"), (NOT_NULL, "usage_id"), (NOT_NULL, "promo_id"), ("accepted_range", "discount_given", 0, None)],
}


def _fails(kind: str, column: str, *args) -> str:
    """What a check counts, as SQL."""
    if kind == NOT_NULL:
        return f"{column} IS NULL"
    if kind == "accepted_values":
        return f"{column} NOT IN ({', '.join(repr(v) for v in args[0])})"
    return " OR ".join(f"{column} {sign} {bound}" for sign, bound in zip("<>", args) if bound is not None)


ALL_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{column}' AS column_name, count(*) AS failing, count(*) = 0 AS passed FROM "
    + (f"(SELECT {column} FROM {{{table}}} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)" if kind == UNIQUE else f"{{{table}}} WHERE {_fails(kind, column, *args)}")
    for table, suite in SUITES.items()
    for kind, column, *args in suite
)


@query("dq_report_all", ALL_SQL)
def _(d):
    return quality.dq_report_all({table: (d.table(table), quality.suite(lines)) for table, lines in SUITES.items()})


@query("dq_report_on_write", ALL_SQL)
def _(d):
    out = None
    for table, lines in SUITES.items():
        rules_, unique = quality.suite(lines)
        report = checked.write_checked(d.table(table), run_dir(d.spark, f"checked-{table}"), table, rules_, unique)
        out = report if out is None else out.unionByName(report)
    return out


@query("dq_orphan_payments", "SELECT payment_id, ride_id FROM {payments} WHERE ride_id NOT IN (SELECT ride_id FROM {rides})")
def _(d):
    return quality.orphans(d.table("payments"), d.table("rides"), "ride_id").select("payment_id", "ride_id")


@query("dq_orphan_payouts", "SELECT payout_id, ride_id FROM {payouts} WHERE ride_id NOT IN (SELECT ride_id FROM {payments})")
def _(d):
    # Payouts whose trip has no payment.
    return quality.orphans(d.table("payouts"), d.table("payments"), "ride_id").select("payout_id", "ride_id")


@query("dq_payment_amount", "SELECT payment_id FROM {payments} WHERE platform_fee + driver_earning <> amount OR promo_discount > 4000")
def _(d):
    # Fee and earning must add up to the amount; a discount above the given limit is reported as well.
    return quality.payment_amount_mismatch(d.table("payments"), 4000).select("payment_id")


@query(
    "dq_platform_revenue",
    """SELECT requested_date AS ride_date, vehicle_type_code FROM {o_rides} WHERE ride_status = 'COMPLETED'
       GROUP BY requested_date, vehicle_category, fare_tier, vehicle_type_code, pickup_province
       HAVING round(sum(total_fare) * 0.20 - sum(promo_discount), 0) < 0""",
)
def _(d):
    return quality.dq_accepted_range(marts.mart_revenue_daily(d.rides), "net_platform_revenue_idr", low=0).select("ride_date", "vehicle_type_code")


@query(
    "dq_completed_has_one_payment",
    """SELECT r.ride_id, count(p.payment_id) AS children FROM {rides} r LEFT JOIN {payments} p ON p.ride_id = r.ride_id
       WHERE upper(r.ride_status) = 'COMPLETED' GROUP BY ALL HAVING count(p.payment_id) <> 1""",
)
def _(d):
    completed = d.table("rides").filter(F.upper("ride_status") == "COMPLETED")
    return quality.not_exactly_one(completed, d.table("payments"), "ride_id")


@query(
    "dq_scd2_overlap",
    """SELECT customer_id, lsn FROM (SELECT customer_id, lsn, ts, ts + INTERVAL 30 DAY AS te, lead(ts) OVER (PARTITION BY customer_id ORDER BY ts) AS nx
       FROM {change_log}) WHERE te > nx""",
)
def _(d):
    # Thirty-day versions laid over the change log overlap wherever changes come closer than that.
    fixed = d.table("change_log").select("customer_id", "lsn", F.col("ts").alias("valid_from"), (F.col("ts") + F.make_dt_interval(days=F.lit(30))).alias("valid_to"))
    return quality.scd2_overlaps(fixed, "customer_id").select("customer_id", "lsn")


@query("dq_exclusive_flags", "SELECT ride_id FROM {o_rides} WHERE is_surge AND has_promo")
def _(d):
    return quality.both_set(d.rides, "is_surge", "has_promo").select("ride_id")


@query("dq_dates_in_range", "SELECT ride_id, requested_at FROM {rides} WHERE requested_at < TIMESTAMP '1995-02-01' OR requested_at > TIMESTAMP '2001-07-01'")
def _(d):
    return quality.dates_outside(d.table("rides"), "requested_at", now("1995-02-01 00:00:00"), now("2001-07-01 00:00:00")).select("ride_id", "requested_at")


@query(
    "dq_mart_coverage",
    """SELECT f.day, fact_rows, mart_rows FROM (SELECT requested_date AS day, count(*) AS fact_rows FROM {o_rides} GROUP BY ALL) f
       FULL JOIN (SELECT requested_date AS day, count(*) AS mart_rows FROM {o_rides} WHERE ride_status = 'COMPLETED' GROUP BY ALL) m ON f.day = m.day
       WHERE fact_rows IS DISTINCT FROM mart_rows""",
)
def _(d):
    revenue = marts.mart_revenue_daily(d.rides)
    return quality.uncovered_days(d.rides, revenue, "requested_date", "ride_date", "completed_trips")


STATUS_OF = """CASE event_type WHEN 'RIDE_REQUESTED' THEN 'REQUESTED' WHEN 'RIDE_ACCEPTED' THEN 'ACCEPTED' WHEN 'PASSENGER_PICKED_UP' THEN 'PICKED_UP'
 WHEN 'RIDE_COMPLETED' THEN 'COMPLETED' ELSE 'CANCELLED' END"""
CTES["o_log"] = f"SELECT event_id, ride_id, {STATUS_OF} AS status, occurred_at AS ts FROM {{ride_events}}"


def status_log(d):
    names = dict(zip(domain.EVENT_TYPES, ["REQUESTED", "ACCEPTED", "PICKED_UP", "COMPLETED", "CANCELLED"]))
    pairs = [F.lit(x) for item in names.items() for x in item]
    return d.table("ride_events").select(
        "event_id", "ride_id", F.create_map(*pairs)[F.col("event_type")].alias("status"), F.col("occurred_at").alias("ts")
    )


@query(
    "dq_transition_legality",
    """SELECT event_id, ride_id, previous_status, status FROM (SELECT *, lag(status) OVER (PARTITION BY ride_id ORDER BY ts, event_id) AS previous_status FROM {o_log})
       WHERE previous_status IS NOT NULL AND previous_status || '>' || status NOT IN
       ('REQUESTED>ACCEPTED', 'REQUESTED>NO_DRIVER', 'ACCEPTED>PICKED_UP', 'ACCEPTED>CANCELLED', 'PICKED_UP>COMPLETED')""",
)
def _(d):
    return quality.dq_transition_legality(status_log(d)).select("event_id", "ride_id", "previous_status", "status")


# Rules ---------------------------------------------------------------------------------------------------------------

CTES["o_fare"] = """SELECT r.ride_id, r.total_fare, CASE WHEN r.distance_km IS NOT NULL AND r.duration_minutes IS NOT NULL THEN
 greatest(7000::decimal(12,2), ((t.base_fare + (t.per_km_rate * r.distance_km)::decimal(10,2) + (t.per_minute_rate * r.duration_minutes)::decimal(10,2))
 * coalesce(r.surge_multiplier, 1)::decimal(4,2) - coalesce(r.promo_discount, 0)::decimal(10,2))::decimal(12,2)) END AS expected_fare
 FROM {rides} r LEFT JOIN {vehicle_types} t USING (vehicle_type_id)"""


@query("recompute_fare", "SELECT ride_id, total_fare::double AS total_fare, expected_fare::double AS expected_fare, (total_fare - expected_fare)::double AS difference FROM {o_fare}")
def _(d):
    return rules.recompute_fare(d.table("rides"), d.table("vehicle_types"))


def demand_sql(c: str) -> str:
    h = f"hour({c})"
    return f"""(CASE WHEN {h} IN (6, 7, 8) THEN 1.8 WHEN {h} IN (9, 10) THEN 1.2 WHEN {h} IN (11, 12, 13) THEN 1.4 WHEN {h} IN (14, 15) THEN 1.0
 WHEN {h} IN (16, 17, 18, 19) THEN 2.1 WHEN {h} IN (20, 21, 22) THEN 1.6 ELSE 0.6 END
 + CASE WHEN dayofweek({c}) IN (0, 6) THEN CASE WHEN {h} BETWEEN 10 AND 21 THEN 0.3 ELSE 0.1 END ELSE 0.0 END)::double"""


@query(
    "demand_band",
    f"SELECT {demand_sql('requested_at')} AS demand, count(*) AS rides, count(*) FILTER (upper(ride_status) = 'COMPLETED') AS completed FROM {{rides}} GROUP BY 1",
)
def _(d):
    return rules.demand_band(d.table("rides"))


@query(
    "surge_reference",
    f"""SELECT r.ride_id, z.zone_code AS pickup_zone_code, {r(f"least(2.2::double, greatest(1.0::double, {demand_sql('r.requested_at')} * (1.0::double + CASE WHEN z.zone_code IN ('JKT-00', 'JKT-05', 'Z01') THEN 0.08::double ELSE 0 END + CASE WHEN hour(r.requested_at) IN (7, 8, 17, 18, 19) THEN 0.12::double ELSE 0 END) / 1.4::double))", 2)} AS reference_multiplier,
        r.surge_multiplier::double AS surge_multiplier FROM {{rides}} r LEFT JOIN {{zones}} z ON z.zone_id = r.pickup_zone_id""",
)
def _(d):
    return rules.surge_reference(d.table("rides"), d.table("zones"), ["JKT-00", "JKT-05", "Z01"])


@query(
    "zone_distance",
    f"""SELECT p.pickup_zone_id, p.dropoff_zone_id, p.rides, {r("sqrt((a.latitude::double - b.latitude::double) * (a.latitude::double - b.latitude::double) + (a.longitude::double - b.longitude::double) * (a.longitude::double - b.longitude::double)) * 111", 3)} AS centroid_km
        FROM (SELECT pickup_zone_id, dropoff_zone_id, count(*) AS rides FROM {{rides}} GROUP BY ALL) p
        LEFT JOIN {{zones}} a ON a.zone_id = p.pickup_zone_id LEFT JOIN {{zones}} b ON b.zone_id = p.dropoff_zone_id""",
)
def _(d):
    return rules.zone_distance(d.table("rides"), d.table("zones"))


SPEED_SQL = """CASE WHEN hour(requested_at) IN (7, 8, 17, 18, 19) THEN 18.0::double WHEN hour(requested_at) BETWEEN 10 AND 14 THEN 24.0::double
 WHEN hour(requested_at) >= 22 OR hour(requested_at) <= 4 THEN 35.0::double ELSE 28.0::double END"""


@query(
    "expected_duration",
    f"""SELECT speed AS speed_kmh, count(*) AS rides, {r('cast(sum(off) AS double) / count(*)', 3)} AS mean_deviation_min FROM (
        SELECT speed, duration_minutes - greatest(6, {r('distance_km::double / speed * 60')}::bigint) AS off
        FROM (SELECT *, {SPEED_SQL} AS speed FROM {{rides}}) WHERE distance_km IS NOT NULL AND duration_minutes IS NOT NULL) GROUP BY ALL""",
)
def _(d):
    return rules.expected_duration(d.table("rides"))


def _at(axis: str) -> str:
    return r(f"a.{axis}::double + (b.{axis}::double - a.{axis}::double) * p.progress", 7)


@query(
    "ping_zone",
    f"""SELECT p.event_id, p.ride_id, p.progress, CASE WHEN upper(r.ride_status) = 'ACCEPTED' THEN 'PICKUP_EN_ROUTE' ELSE 'TRIP_IN_PROGRESS' END AS status_context,
        CASE WHEN p.progress >= 0.5 THEN b.zone_id ELSE a.zone_id END AS zone_id, {_at('latitude')} AS latitude, {_at('longitude')} AS longitude
        FROM (SELECT event_id, ride_id, (substr(event_id, 3)::bigint % 101)::double / 100.0::double AS progress FROM {{ride_events}}) p
        JOIN {{rides}} r ON r.ride_id = p.ride_id AND upper(r.ride_status) IN ('ACCEPTED', 'PICKED_UP') AND r.driver_id IS NOT NULL
        JOIN {{zones}} a ON a.zone_id = r.pickup_zone_id
        JOIN {{zones}} b ON b.zone_id = CASE WHEN upper(r.ride_status) = 'ACCEPTED' THEN r.pickup_zone_id ELSE r.dropoff_zone_id END""",
)
def _(d):
    number = F.substring("event_id", 3, 18).cast("long")
    pings = d.table("ride_events").select("event_id", "ride_id", ((number % 101).cast("double") / 100.0).alias("progress"))
    return rules.ping_zone(pings, d.table("rides"), d.table("zones"))


BACKLOG = f"upper(ride_status) NOT IN ('COMPLETED', 'CANCELLED', 'NO_DRIVER') AND requested_at >= TIMESTAMP '{NOW}' - INTERVAL 14 DAY"


@query("open_ride_backlog", f"SELECT ride_id, driver_id, requested_at FROM {{rides}} WHERE {BACKLOG}")
def _(d):
    return rules.open_ride_backlog(d.table("rides"), now()).select("ride_id", "driver_id", "requested_at")


@query(
    "free_drivers",
    f"SELECT driver_id FROM {{drivers}} WHERE upper(status) = 'ACTIVE' AND driver_id NOT IN (SELECT driver_id FROM {{rides}} WHERE driver_id IS NOT NULL AND {BACKLOG})",
)
def _(d):
    return rules.free_drivers(d.table("drivers"), rules.open_ride_backlog(d.table("rides"), now())).select("driver_id")


@query("max_ride_sequence", "SELECT max(right(ride_code, 6)::bigint) AS max_sequence FROM {rides} WHERE regexp_full_match(ride_code, 'RIDE-[0-9]{8}-[0-9]{6}')")
def _(d):
    return rules.max_ride_sequence(d.table("rides"))


CANDIDATE = "left(ride_code, 14) || lpad(((right(ride_code, 6)::bigint + CASE WHEN right(ride_code, 1) = '0' THEN 0 ELSE 1 END) % 1000000)::varchar, 6, '0')"


@query(
    "code_exists",
    f"SELECT ride_id, code, code IN (SELECT ride_code FROM {{rides}}) AS taken FROM (SELECT ride_id, {CANDIDATE} AS code FROM {{rides}})",
)
def _(d):
    step = F.when(F.col("ride_code").endswith("0"), 0).otherwise(1)
    # The last six digits, as in the SQL, also where a longer key makes the code longer.
    number = (F.right("ride_code", F.lit(6)).cast("long") + step) % 1000000
    rides = d.table("rides")
    wanted = rides.select("ride_id", F.concat(F.substring("ride_code", 1, 14), F.lpad(number.cast("string"), 6, "0")).alias("code"))
    return rules.code_exists(wanted, rides.withColumnRenamed("ride_code", "code"), "code")


# Numbers times 1,000, so that codes of six to nine digits stand side by side at every scale.
LONG_CODE = "left(ride_code, 14) || (CASE WHEN length(n) < 6 THEN lpad(n, 6, '0') ELSE n END)"
CTES["o_long_codes"] = f"SELECT ride_id, {LONG_CODE} AS ride_code FROM (SELECT ride_id, ride_code, (substr(ride_code, 15)::bigint * 1000)::varchar AS n FROM {{rides}})"


def long_codes(d):
    number = F.substring("ride_code", 15, 20).cast("long")
    return d.table("rides").select("ride_id", rules.code_after(F.col("ride_code"), number * 999).alias("ride_code"))


@query("max_ride_sequence_any_length", "SELECT max(substr(ride_code, 15)::bigint) AS max_sequence FROM {o_long_codes} WHERE regexp_full_match(ride_code, 'RIDE-[0-9]{8}-[0-9]{6,18}')")
def _(d):
    return rules.max_ride_sequence_any_length(long_codes(d))


@query(
    "code_exists_any_length",
    f"""WITH w AS (SELECT ride_id, ride_code, (substr(ride_code, 15)::bigint + CASE WHEN substr(ride_code, 15)::bigint % 3000 = 0 THEN 0 ELSE 1000 END)::varchar AS n FROM {{o_long_codes}}),
        c AS (SELECT ride_id, {LONG_CODE} AS code FROM w) SELECT ride_id, code, code IN (SELECT ride_code FROM {{o_long_codes}}) AS taken FROM c""",
)
def _(d):
    codes = long_codes(d)
    step = F.when(F.substring("ride_code", 15, 20).cast("long") % 3000 == 0, 0).otherwise(1000)
    wanted = codes.select("ride_id", rules.code_after(F.col("ride_code"), step).alias("code"))
    return rules.code_exists(wanted, codes.withColumnRenamed("ride_code", "code"), "code")


@query(
    "driver_trip_counter",
    """SELECT d.driver_id, ifnull(d.total_trips, 0) AS stored_trips, count(r.ride_id) AS completed_trips, count(r.ride_id) - ifnull(d.total_trips, 0) AS difference
       FROM {drivers} d LEFT JOIN {rides} r ON r.driver_id = d.driver_id AND upper(r.ride_status) = 'COMPLETED' GROUP BY d.driver_id, d.total_trips""",
)
def _(d):
    return rules.trip_counter(d.table("drivers"), d.table("rides"), "driver_id")


@query(
    "passenger_trip_counter",
    """SELECT d.passenger_id, ifnull(d.total_trips, 0) AS stored_trips, count(r.ride_id) AS completed_trips, count(r.ride_id) - ifnull(d.total_trips, 0) AS difference
       FROM {passengers} d LEFT JOIN {rides} r ON r.passenger_id = d.passenger_id AND upper(r.ride_status) = 'COMPLETED' GROUP BY d.passenger_id, d.total_trips""",
)
def _(d):
    return rules.trip_counter(d.table("passengers"), d.table("rides"), "passenger_id")


