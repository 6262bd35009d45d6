"""Models known by their schemas: dimensions, transaction facts, data marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.operators import keymap
from fleetmart.plans import dims, planned
from fleetmart.session import run_dir
from registry.core import CTES, FIRST_LOAD, SECOND_LOAD, SNAPSHOT_NOW, avg, query, r, today

NULL_MARK = "_dbt_utils_surrogate_key_null_"


def key(*parts: str) -> str:
    text = " || '-' || ".join(f"coalesce({p}::varchar, '{NULL_MARK}')" for p in parts)
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


def opt_key(part: str) -> str:
    return f"CASE WHEN {part} IS NOT NULL THEN {key(part)} END"


def day(c: str) -> str:
    return f"(year({c}) * 10000 + month({c}) * 100 + day({c}))::bigint"


METHODS = ["cash", "wallet", "card", "transfer"]
CTES["o_pay"] = """SELECT *, CASE method_id WHEN 1 THEN 'cash' WHEN 2 THEN 'wallet' WHEN 3 THEN 'card' ELSE 'transfer' END AS payment_method
 FROM {payments}"""


def payments(d):
    method = F
    for i, name in enumerate(METHODS[:-1], start=1):
        method = method.when(F.col("method_id") == i, name)
    return d.table("payments").withColumn("payment_method", method.otherwise(METHODS[-1]))


@query(
    "dim_time",
    """SELECT h.time_key, h.time_key AS hour_num, CASE WHEN h.time_key BETWEEN 7 AND 9 THEN 'morning_peak' WHEN h.time_key BETWEEN 17 AND 19 THEN 'evening_peak'
        WHEN h.time_key >= 22 OR h.time_key <= 4 THEN 'late_night' ELSE 'off_peak' END AS time_bucket, count(r.ride_id) AS trips
        FROM (SELECT unnest(range(24)) AS time_key) h LEFT JOIN {rides} r ON hour(r.requested_at) = h.time_key GROUP BY ALL""",
)
def _(d):
    return planned.dim_time(d.table("rides"))


@query(
    "dim_location",
    f"SELECT {key('zone_id')} AS location_key, city, zone_name AS area_name, latitude::double AS latitude_center, longitude::double AS longitude_center FROM {{zones}}",
)
def _(d):
    return planned.dim_location(d.table("zones"))


@query("dim_payment_method", f"SELECT DISTINCT {key('payment_method')} AS payment_method_key, payment_method AS payment_method_name FROM {{o_pay}}")
def _(d):
    return planned.dim_payment_method(payments(d))


@query("dim_trip_status", f"SELECT DISTINCT {key('ride_status')} AS trip_status_key, ride_status AS trip_status_name FROM {{o_rides}}")
def _(d):
    return planned.dim_trip_status(d.table("rides"))


@query(
    "dim_promo",
    f"""SELECT {key('promo_id')} AS promo_key, promo_id::varchar AS promo_id, promo_code, promo_name, promo_type, discount_type, discount_value::double AS discount_value,
        budget_amount::double AS budget_amount, promo_status, valid_from::date AS start_date, valid_until::date AS end_date FROM {{promotions}}""",
)
def _(d):
    return planned.dim_promo(d.table("promotions"))


@query(
    "dim_vehicle",
    f"""SELECT {key("'V-' || driver_id")} AS vehicle_key, 'V-' || driver_id AS vehicle_id, driver_id, license_plate AS plate_number, type_name AS vehicle_type,
        vehicle_brand AS brand, vehicle_model AS model, vehicle_year AS production_year, capacity AS seat_capacity FROM {{drivers}} LEFT JOIN {{vehicle_types}} USING (vehicle_type_id)""",
)
def _(d):
    return planned.dim_vehicle(d.table("drivers"), d.table("vehicle_types"))


def versions_sql(table: str, id_: str, status: str) -> str:
    """The three versions a key can have, of those of one third two."""
    k, second = f"cast(substr({id_}, 3) AS bigint)", f"TIMESTAMP '{SECOND_LOAD}' + INTERVAL 1 DAY * (cast(substr({id_}, 3) AS bigint) % 700)"
    return f"""SELECT {id_}, TIMESTAMP '{FIRST_LOAD}' AS valid_from, CASE WHEN {k} % 3 <> 0 THEN {second} ELSE updated_at END AS valid_to, 'PENDING' AS status, true AS is_first FROM {{{table}}}
 UNION ALL SELECT {id_}, {second}, updated_at, '{status}', false FROM {{{table}}} WHERE {k} % 3 <> 0
 UNION ALL SELECT {id_}, updated_at, NULL, NULL, false FROM {{{table}}}"""


CTES["o_driver_versions"] = versions_sql("drivers", "driver_id", "SUSPENDED")
CTES["o_passenger_versions"] = versions_sql("passengers", "passenger_id", "BANNED")


def at(version: str, id_: str, moment: str) -> str:
    """The version of a fact row's key at its moment."""
    table = {"driver_id": "o_driver_versions", "passenger_id": "o_passenger_versions"}[id_]
    return f"LEFT JOIN {{{table}}} {version} ON {version}.{id_} = f.{id_} AND ({version}.is_first OR {version}.valid_from <= f.{moment}) AND ({version}.valid_to IS NULL OR f.{moment} < {version}.valid_to)"


def version_key(version: str, id_: str) -> str:
    return f"CASE WHEN {version}.{id_} IS NOT NULL THEN {key(f'{version}.{id_}', f'{version}.valid_from')} END"


DRIVER_KEY, CUSTOMER_KEY = version_key("dv", "driver_id"), version_key("pv", "passenger_id")


def customers(d):
    return dims.dim_passengers(d.passenger_versions, d.zones, today(SNAPSHOT_NOW), all_versions=True)


def star_drivers(d):
    return dims.dim_drivers(d.driver_versions, d.vehicle_types, d.zones, all_versions=True)


@query(
    "dim_customer",
    f"""SELECT {key('p.passenger_id', 'v.valid_from')} AS customer_key, p.passenger_id AS customer_id, p.passenger_name AS full_name, p.gender, p.age_bucket AS age_group,
        p.registered_at::date AS signup_date, p.email, p.phone_number, s.current_segment, p.home_city AS city, v.valid_from, v.valid_to, v.valid_to IS NULL AS is_current
        FROM {{o_passengers}} p JOIN {{o_passenger_versions}} v USING (passenger_id) LEFT JOIN (SELECT passenger_id, arg_max(segment_name, snapshot_date) AS current_segment FROM {{segments}} GROUP BY ALL) s USING (passenger_id)""",
)
def _(d):
    return planned.dim_customer(customers(d), d.table("segments"))


@query(
    "dim_driver",
    f"""SELECT {key('d.driver_id', 'v.valid_from')} AS driver_key, d.driver_id, driver_name AS full_name, coalesce(v.status, driver_status) AS driver_status, joined_at::date AS join_date, home_city AS city,
        sim_number AS license_number, v.valid_from, v.valid_to, v.valid_to IS NULL AS is_current FROM {{o_drivers}} d JOIN {{o_driver_versions}} v USING (driver_id)""",
)
def _(d):
    return planned.dim_driver(star_drivers(d))


@query(
    "dim_customer_segment",
    f"SELECT {key('passenger_id', 'snapshot_date')} AS customer_segment_key, passenger_id AS customer_id, segment_name, segment_score::double AS segment_score, snapshot_date FROM {{segments}}",
)
def _(d):
    return planned.dim_customer_segment(d.table("segments"))


@query(
    "fct_trip",
    f"""SELECT {key('f.ride_id')} AS trip_key, f.ride_id AS trip_id, {day('requested_at')} AS request_date_key, hour(requested_at)::bigint AS request_time_key,
        {day('picked_up_at')} AS pickup_date_key, {day('completed_at')} AS dropoff_date_key, {CUSTOMER_KEY} AS customer_key, {DRIVER_KEY} AS driver_key, {opt_key('vehicle_id')} AS vehicle_key,
        estimated_distance_km::double AS estimated_distance_km, estimated_fare::double AS estimated_fare,
        {opt_key('pickup_zone_id')} AS pickup_location_key, {opt_key('dropoff_zone_id')} AS dropoff_location_key, {key('upper(ride_status)')} AS trip_status_key,
        distance_km::double AS actual_distance_km, total_fare::double AS actual_fare, surge_multiplier::double AS surge_multiplier,
        date_sub('minute', picked_up_at, completed_at) AS trip_duration_minute, date_sub('minute', requested_at, picked_up_at) AS waiting_time_minute,
        upper(ride_status) = 'COMPLETED' AS is_completed, upper(ride_status) = 'CANCELLED' AS is_cancelled, created_at, updated_at FROM {{trips}} f {at('dv', 'driver_id', 'requested_at')} {at('pv', 'passenger_id', 'requested_at')}""",
)
def _(d):
    return planned.fct_trip(d.table("trips"), d.driver_versions, d.passenger_versions)


@query(
    "fct_payment",
    f"""SELECT {key('payment_id')} AS payment_key, payment_id, {key('ride_id')} AS trip_key, {CUSTOMER_KEY} AS customer_key, {day('created_at')} AS payment_date_key,
        {key('payment_method')} AS payment_method_key, amount::double AS gross_amount, promo_discount::double AS discount_amount, tax_amount::double AS tax_amount,
        toll_amount::double AS toll_amount, tip_amount::double AS tip_amount, net_amount::double AS net_amount, payment_status, paid_at AS paid_ts, created_at, updated_at FROM {{o_pay}} f {at('pv', 'passenger_id', 'created_at')}""",
)
def _(d):
    return planned.fct_payment(payments(d), d.passenger_versions)


@query(
    "fct_driver_payout",
    f"""SELECT {key('payout_id')} AS payout_key, payout_id, {key('ride_id')} AS trip_key, {DRIVER_KEY} AS driver_key, {day('payout_date')} AS payout_date_key,
        base_earning::double AS base_earning, incentive_amount::double AS incentive_amount, bonus_amount::double AS bonus_amount,
        deduction_amount::double AS deduction_amount, final_payout_amount::double AS final_payout_amount, payout_status, created_at, updated_at FROM {{payouts}} f {at('dv', 'driver_id', 'created_at')}""",
)
def _(d):
    return planned.fct_driver_payout(d.table("payouts"), d.driver_versions)


@query(
    "fct_rating",
    f"""SELECT {key("'rating'", 'ride_id')} AS rating_key, 'RT-' || ride_id AS rating_id, {key('ride_id')} AS trip_key, {CUSTOMER_KEY} AS customer_key,
        {DRIVER_KEY} AS driver_key, {day('completed_at')} AS rating_date_key, round(passenger_rating, 0)::bigint AS rating_score,
        notes IS NOT NULL AS has_review_text, completed_at AS rated_ts, completed_at AS created_at, updated_at FROM {{rides}} f {at('dv', 'driver_id', 'completed_at')} {at('pv', 'passenger_id', 'completed_at')} WHERE passenger_rating IS NOT NULL""",
)
def _(d):
    return planned.fct_rating(d.table("rides"), d.driver_versions, d.passenger_versions)


@query(
    "fct_promo_redemption",
    f"""SELECT {key('usage_id')} AS promo_redemption_key, usage_id AS redemption_id, {key('promo_id')} AS promo_key, {key('ride_id')} AS trip_key,
        {CUSTOMER_KEY} AS customer_key, {day('used_at')} AS redemption_date_key, discount_given::double AS discount_amount, redemption_status, used_at AS redeemed_ts, created_at, updated_at FROM {{promo_usage}} f {at('pv', 'passenger_id', 'used_at')}""",
)
def _(d):
    return planned.fct_promo_redemption(d.table("promo_usage"), d.passenger_versions)


STAR_KEYS = [
    ("fct_trip", "driver_key", "trips", "dv", "driver_id", "requested_at"), ("fct_trip", "customer_key", "trips", "pv", "passenger_id", "requested_at"),
    ("fct_payment", "customer_key", "payments", "pv", "passenger_id", "created_at"), ("fct_driver_payout", "driver_key", "payouts", "dv", "driver_id", "created_at"),
    ("fct_rating", "driver_key", "rides", "dv", "driver_id", "completed_at"), ("fct_rating", "customer_key", "rides", "pv", "passenger_id", "completed_at"),
    ("fct_promo_redemption", "customer_key", "promo_usage", "pv", "passenger_id", "used_at"),
]
# Every row whose driver or passenger is known has a version, so none may be an orphan.
ORPHANS = " UNION ALL ".join(
    f"SELECT '{fact}' AS fact, '{name}' AS key, count({v}.{id_}) AS rows, 0::bigint AS orphans FROM {{{source}}} f {at(v, id_, moment)}" + (" WHERE passenger_rating IS NOT NULL" if fact == "fct_rating" else "")
    for fact, name, source, v, id_, moment in STAR_KEYS
)


@query("dq_star_orphans", ORPHANS)
def _(d):
    drivers, people = d.driver_versions, d.passenger_versions
    facts = {
        "fct_trip": planned.fct_trip(d.table("trips"), drivers, people), "fct_payment": planned.fct_payment(payments(d), people),
        "fct_driver_payout": planned.fct_driver_payout(d.table("payouts"), drivers), "fct_rating": planned.fct_rating(d.table("rides"), drivers, people),
        "fct_promo_redemption": planned.fct_promo_redemption(d.table("promo_usage"), people),
    }
    dimensions = {"driver_key": planned.dim_driver(star_drivers(d)), "customer_key": planned.dim_customer(customers(d), d.table("segments"))}
    return planned.star_orphans(facts, dimensions)


DONE = "ride_status = 'COMPLETED'"


def rate(cond: str) -> str:
    return r(f"(count(*) FILTER ({cond}))::double / count(*)::double * 100.0::double", 2)


def done(c: str) -> str:
    return f"CASE WHEN {DONE} THEN {c} END"


CTES["o_city_trips"] = """SELECT t.* REPLACE (upper(t.ride_status) AS ride_status), z.city FROM {trips} t LEFT JOIN {o_zones} z ON z.zone_id = t.pickup_zone_id"""
CTES["o_trip_daily"] = f"""SELECT {day('requested_at')} AS date_key, city, count(*) AS total_trip_requested,
 count(*) FILTER ({DONE}) AS total_trip_completed, count(*) FILTER (ride_status = 'CANCELLED') AS total_trip_cancelled,
 {rate(DONE)} AS completion_rate, {rate("ride_status = 'CANCELLED'")} AS cancellation_rate, {r(avg('estimated_distance_km'), 2)} AS avg_estimated_distance_km,
 {r(avg(done('distance_km')), 2)} AS avg_actual_distance_km, {r(avg("date_sub('minute', picked_up_at, completed_at)"), 2)} AS avg_trip_duration_minute,
 {r(avg("date_sub('minute', requested_at, picked_up_at)"), 2)} AS avg_waiting_time_minute,
 {r(avg(done('total_fare')), 2)} AS avg_actual_fare FROM {{o_city_trips}} GROUP BY 1, 2"""


def trip_daily(d, low=None, high=None):
    """The mart of all days, or of a range of days from the trips of these days alone."""
    trips = d.table("trips")
    return planned.dm_trip_daily_city(trips if low is None else planned.between_days(trips, "requested_at", low, high), d.zones)


@query("dm_trip_daily_city", "SELECT * FROM {o_trip_daily}")
def _(d):
    return trip_daily(d)


@query("date_key_range", "SELECT * FROM {o_trip_daily} WHERE date_key BETWEEN 19970101 AND 19970131")
def _(d):
    return planned.date_key_range(trip_daily(d, 19970101, 19970131), 19970101, 19970131)


LISTING = "SELECT date_key, city, total_trip_requested, total_trip_completed, total_trip_cancelled, completion_rate, cancellation_rate"


@query("order_mart_queries", LISTING + " FROM {o_trip_daily} WHERE date_key BETWEEN 19970101 AND 19970131 ORDER BY date_key, city NULLS FIRST")
def _(d):
    out = planned.date_key_range(trip_daily(d, 19970101, 19970131), 19970101, 19970131)
    return out.select(
        "date_key", "city", "total_trip_requested", "total_trip_completed", "total_trip_cancelled", "completion_rate", "cancellation_rate"
    ).orderBy("date_key", "city")


@query(
    "dm_trip_hourly_city",
    f"""SELECT {day('requested_date')} AS date_key, hour(requested_at)::bigint AS time_key, pickup_city AS city, count(*) AS total_trip_requested,
        count(*) FILTER ({DONE}) AS total_trip_completed, count(*) FILTER (ride_status = 'CANCELLED') AS total_trip_cancelled,
        {r(avg('surge_multiplier'), 3)} AS avg_surge_multiplier FROM {{o_rides}} GROUP BY 1, 2, 3""",
)
def _(d):
    return planned.dm_trip_hourly_city(d.rides)


CTES["o_payout"] = """SELECT ride_id, sum(final_payout_amount) AS payout, sum(bonus_amount) AS bonus, sum(incentive_amount) AS incentive FROM {payouts} GROUP BY ALL"""


def z(c: str) -> str:
    return f"coalesce(sum({c}), 0)"


SUMS = {"amount": "gross", "promo_discount": "discount", "tax_amount": "tax", "toll_amount": "toll", "tip_amount": "tip", "net_amount": "net"}
CTES["o_paid"] = "SELECT ride_id, " + ", ".join(f"sum({c}) AS paid_{c}" for c in SUMS) + " FROM {payments} WHERE payment_status = 'SUCCESS' GROUP BY ALL"
CTES["o_finance"] = f"""SELECT {day('requested_at')} AS date_key, city, {', '.join(f"{r(z(f'paid_{c}'), 2)} AS total_{n}_amount" for c, n in SUMS.items())},
        {r(z('payout'), 2)} AS total_driver_payout, {r(z('paid_net_amount') + ' - ' + z('payout'), 2)} AS estimated_platform_revenue,
        count(*) FILTER ({DONE}) AS completed_trip_count,
        {r(f"{z('paid_net_amount')}::double / nullif((count(*) FILTER ({DONE}))::double, 0)", 2)} AS avg_revenue_per_trip
        FROM {{o_city_trips}} LEFT JOIN {{o_paid}} USING (ride_id) LEFT JOIN {{o_payout}} USING (ride_id) GROUP BY 1, 2"""


@query("dm_finance_daily_city", "SELECT * FROM {o_finance}")
def _(d):
    return planned.dm_finance_daily_city(d.table("payments"), d.table("payouts"), d.table("trips"), d.zones)


@query(
    "finance_day_listing",
    "SELECT date_key, city, total_net_amount, total_driver_payout, estimated_platform_revenue FROM {o_finance} WHERE date_key = 19980615",
)
def _(d):
    mart = planned.dm_finance_daily_city(d.table("payments"), d.table("payouts"), d.table("trips"), d.zones)
    return planned.date_key_range(mart, 19980615, 19980615).select(
        "date_key", "city", "total_net_amount", "total_driver_payout", "estimated_platform_revenue"
    )


@query(
    "dm_payment_method_daily",
    f"""SELECT {day('created_at')} AS date_key, payment_method AS payment_method_name, count(*) AS payment_count, {r('sum(net_amount)', 2)} AS total_net_amount,
        {r(avg('net_amount'), 2)} AS avg_net_amount, count(*) FILTER (payment_status = 'SUCCESS') AS success_payment_count,
        count(*) FILTER (payment_status = 'FAILED') AS failed_payment_count FROM {{o_pay}} GROUP BY 1, 2""",
)
def _(d):
    return planned.dm_payment_method_daily(payments(d))


CTES["o_promo_daily"] = f"""SELECT {day('u.used_at')} AS date_key, p.promo_code, p.promo_name, count(*) AS total_redemption, {r('sum(u.discount_given)', 2)} AS total_discount_amount,
        count(DISTINCT u.passenger_id) AS unique_customer_count, count(DISTINCT u.ride_id) AS total_trip_count,
        count(DISTINCT CASE WHEN upper(t.ride_status) = 'COMPLETED' THEN u.ride_id END) AS completed_trip_count
        FROM {{promo_usage}} u LEFT JOIN {{rides}} t ON t.ride_id = u.ride_id LEFT JOIN {{promotions}} p ON p.promo_id = u.promo_id GROUP BY 1, 2, 3"""


def promo_daily(d, low=None, high=None):
    usage = d.table("promo_usage")
    return planned.dm_promo_daily(usage if low is None else planned.between_days(usage, "used_at", low, high), d.table("promotions"), d.table("rides"))


@query("dm_promo_daily", "SELECT * FROM {o_promo_daily}")
def _(d):
    return promo_daily(d)


PROMO_LISTING = "date_key, promo_code, total_redemption, total_discount_amount, unique_customer_count"


@query("order_promo_listing", f"SELECT {PROMO_LISTING} FROM {{o_promo_daily}} WHERE date_key BETWEEN 19970101 AND 19970131 ORDER BY total_redemption DESC")
def _(d):
    out = planned.date_key_range(promo_daily(d, 19970101, 19970131), 19970101, 19970131)
    return out.select(*PROMO_LISTING.split(", ")).orderBy(F.desc("total_redemption"))


@query(
    "dm_campaign_daily_channel",
    f"""SELECT {day('spend_date')} AS date_key, channel_name, campaign_name, {r('sum(spend_amount)', 2)} AS spend_amount, sum(impressions)::bigint AS impressions,
        sum(clicks)::bigint AS clicks, sum(installs)::bigint AS installs, {r('sum(clicks)::double / nullif(sum(impressions)::double, 0)', 4)} AS ctr,
        {r('sum(spend_amount)::double / nullif(sum(installs)::double, 0)', 2)} AS cpi FROM {{campaign_spend}} GROUP BY 1, 2, 3""",
)
def _(d):
    return planned.dm_campaign_daily_channel(d.table("campaign_spend"))


@query(
    "dm_customer_segment_daily",
    f"SELECT snapshot_date, segment_name, count(DISTINCT passenger_id) AS customer_count, {r(avg('segment_score'), 2)} AS avg_segment_score FROM {{segments}} GROUP BY ALL",
)
def _(d):
    return planned.dm_customer_segment_daily(d.table("segments"))


CTES["o_driver_daily"] = f"""SELECT {day('requested_date')} AS date_key, driver_id, pickup_city AS city, count(*) AS total_trip_assigned, count(*) FILTER ({DONE}) AS total_trip_completed,
        count(*) FILTER (ride_status = 'CANCELLED') AS total_trip_cancelled, {rate(DONE)} AS completion_rate, {r(avg('passenger_rating'), 2)} AS avg_rating_score,
        {r(z(done('distance_km')), 2)} AS total_actual_distance_km, {r(z(done('total_fare')), 2)} AS total_working_revenue, {r(z('payout'), 2)} AS total_payout_amount
        FROM {{o_rides}} LEFT JOIN {{o_payout}} USING (ride_id) WHERE driver_id IS NOT NULL GROUP BY 1, 2, 3"""


@query("dm_driver_daily_performance", "SELECT * FROM {o_driver_daily}")
def _(d):
    return planned.dm_driver_daily_performance(d.rides, d.table("payouts"))


DRIVER_LISTING = "date_key, driver_id, city, total_trip_completed, avg_rating_score, total_payout_amount"


@query("order_driver_listing", f"SELECT {DRIVER_LISTING} FROM {{o_driver_daily}} WHERE date_key = 19980615 ORDER BY total_trip_completed DESC")
def _(d):
    rides = planned.between_days(d.rides, "requested_at", 19980615, 19980615)
    out = planned.date_key_range(planned.dm_driver_daily_performance(rides, d.table("payouts")), 19980615, 19980615)
    return out.select(*DRIVER_LISTING.split(", ")).orderBy(F.desc("total_trip_completed"))


@query(
    "dm_driver_monthly_summary",
    f"""SELECT strftime(requested_date, '%Y%m') AS month_key, driver_id, pickup_city AS city, count(*) FILTER ({DONE}) AS total_trip_completed,
        {r(avg('passenger_rating'), 2)} AS avg_rating_score, {r(z('payout'), 2)} AS total_payout_amount, {r(z('bonus'), 2)} AS total_bonus_amount,
        {r(z('incentive'), 2)} AS total_incentive_amount FROM {{o_rides}} LEFT JOIN {{o_payout}} USING (ride_id) WHERE driver_id IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(d):
    return planned.dm_driver_monthly_summary(d.rides, d.table("payouts"))


@query(
    "dim_key_map",
    """WITH l AS (SELECT passenger_id, CASE WHEN substr(passenger_id, 3)::bigint % 3 <> 0 THEN 1 ELSE 2 END AS load FROM {passengers})
       SELECT passenger_id AS natural_key, row_number() OVER (ORDER BY load, passenger_id) AS dense_key, load FROM l""",
)
def _(d):
    # The second load repeats the keys of the first, which keep their numbers.
    path, keys = run_dir(d.spark, "key-map"), d.table("passengers").select("passenger_id")
    keymap.extend_key_map(d.spark, path, keys.where(F.substring("passenger_id", 3, 18).cast("long") % 3 != 0), "passenger_id", 400)
    return keymap.extend_key_map(d.spark, path, keys.unionByName(keys), "passenger_id", 400)
