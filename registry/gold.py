"""Marts and the aggregate functions they use."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions.numbers import mean, percent, ratio, round_to
from fleetmart.operators import sketches
from fleetmart.plans import marts
from registry.core import CTES, NOW, avg, now, pct, query, r, today

STAMP = f"TIMESTAMP '{NOW}' AS refreshed_at"
DONE = "ride_status = 'COMPLETED'"
UPLIFT = "cast(total_fare::double - total_fare::double / nullif(surge_multiplier::double, 0) AS decimal(18,6))"


def done(expr: str) -> str:
    return f"CASE WHEN {DONE} THEN {expr} END"


def done_avg(c: str, places: int) -> str:
    return r(avg(done(c)), places)


MINUTES = "(cast(sum(acceptance_duration_secs) AS double) / nullif(cast(count(acceptance_duration_secs) AS double), 0) / 60.0::double)"

DAILY_SQL = f"""
SELECT requested_date AS ride_date, vehicle_type_code, vehicle_type_name, vehicle_category, pickup_city, pickup_province,
       pickup_area_type, time_bucket, count(*) AS total_requests,
       count(*) FILTER ({DONE}) AS completed_rides, count(*) FILTER (ride_status = 'CANCELLED') AS cancelled_rides,
       count(*) FILTER (ride_status = 'NO_DRIVER') AS no_driver_rides,
       count(*) FILTER (ride_status = 'ACCEPTED' OR ride_status = 'PICKED_UP') AS in_progress_rides,
       {pct(f'count(*) FILTER ({DONE})', 'count(*)')} AS completion_rate_pct,
       {pct("count(*) FILTER (ride_status = 'CANCELLED')", 'count(*)')} AS cancellation_rate_pct,
       {pct('count(*) FILTER (is_surge)', 'count(*)')} AS surge_rate_pct,
       {r(f'sum({done("total_fare")})')} AS gross_revenue_idr, {done_avg('total_fare', 0)} AS avg_fare_idr,
       {r(f'max({done("total_fare")})')} AS max_fare_idr, {r(f'sum({done("promo_discount")})')} AS total_promo_idr,
       {done_avg('distance_km', 2)} AS avg_distance_km, {r(f'sum({done("distance_km")})', 2)} AS total_distance_km,
       {done_avg('duration_minutes', 1)} AS avg_trip_minutes, {r(MINUTES, 1)} AS avg_acceptance_minutes,
       {done_avg('driver_rating', 2)} AS avg_driver_rating, {done_avg('passenger_rating', 2)} AS avg_passenger_rating,
       count(*) FILTER (has_promo AND {DONE}) AS promo_rides_count, {STAMP}
FROM {{o_rides}} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
"""
CTES["o_daily"] = DAILY_SQL


@query("mart_daily_ride_summary", DAILY_SQL)
def _(d):
    return marts.mart_daily_ride_summary(d.rides, now())


@query(
    "mart_zone_heatmap",
    f"""SELECT requested_date AS ride_date, pickup_zone_code, pickup_zone_name, pickup_city, pickup_province, pickup_area_type,
        dropoff_zone_code, dropoff_zone_name, is_same_zone_trip, time_bucket, count(*) AS trip_count,
        {r('sum(total_fare)')} AS total_fare_idr, {r(avg('total_fare'))} AS avg_fare_idr, {r(avg('distance_km'), 2)} AS avg_distance_km,
        {r(avg('duration_minutes'), 1)} AS avg_duration_min, count(*) FILTER (is_surge) AS surge_trip_count,
        {r(avg('surge_multiplier'), 2)} AS avg_surge_multiplier, {STAMP}
        FROM {{o_rides}} WHERE {DONE} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""",
)
def _(d):
    return marts.mart_zone_heatmap(d.rides, now())


@query(
    "mart_cancellation_analysis",
    f"""SELECT requested_date AS ride_date, ifnull(cancellation_reason, 'Unknown') AS cancellation_reason, vehicle_type_code,
        vehicle_type_name, pickup_zone_code, pickup_zone_name, pickup_city, time_bucket, count(*) AS cancelled_count,
        count(*) - count(acceptance_duration_secs) AS no_acceptance_count, count(acceptance_duration_secs) AS post_acceptance_count,
        {r(MINUTES, 2)} AS avg_time_to_accept_min, {STAMP}
        FROM {{o_rides}} WHERE ride_status = 'CANCELLED' OR ride_status = 'NO_DRIVER' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
)
def _(d):
    return marts.mart_cancellation_analysis(d.rides, now())


@query(
    "mart_revenue_daily",
    f"""SELECT requested_date AS ride_date, vehicle_category, fare_tier, vehicle_type_code, pickup_province,
        count(*) AS completed_trips, count(*) FILTER (is_surge) AS surge_trips, count(*) FILTER (has_promo) AS promo_trips,
        {r('sum(total_fare)')} AS gmv_idr, {r(avg('total_fare'))} AS avg_gmv_per_trip, {r('sum(base_fare)')} AS total_base_fare,
        {r('sum(distance_fare)')} AS total_distance_fare, {r('sum(time_fare)')} AS total_time_fare,
        {r(f'sum({UPLIFT})')} AS surge_uplift_idr, {r('sum(promo_discount)')} AS promo_discount_idr,
        {r('sum(total_fare) * 0.20')} AS platform_revenue_idr, {r('sum(total_fare) * 0.80')} AS driver_earnings_idr,
        {r('sum(total_fare) * 0.20 - sum(promo_discount)')} AS net_platform_revenue_idr,
        {r('sum(total_fare)::double / nullif(sum(distance_km)::double, 0)')} AS revenue_per_km, {STAMP}
        FROM {{o_rides}} WHERE {DONE} GROUP BY 1, 2, 3, 4, 5""",
)
def _(d):
    return marts.mart_revenue_daily(d.rides, now())


@query(
    "mart_surge_analysis",
    f"""SELECT requested_date AS ride_date, time_bucket, pickup_zone_code, pickup_zone_name, pickup_city, vehicle_type_code,
        count(*) FILTER (surge_multiplier = 1.0) AS flat_trips, count(*) FILTER (surge_multiplier = 1.2) AS surge_12x_trips,
        count(*) FILTER (surge_multiplier = 1.5) AS surge_15x_trips, count(*) FILTER (surge_multiplier = 2.0) AS surge_20x_trips,
        count(*) AS total_trips, {r(avg('surge_multiplier'), 3)} AS avg_surge_multiplier, {r('max(surge_multiplier)', 2)} AS peak_surge_multiplier,
        {r(f'sum({UPLIFT})')} AS surge_incremental_idr, {r('sum(total_fare)')} AS total_fare_idr,
        {pct(f'sum({UPLIFT})', 'sum(total_fare)')} AS surge_pct_of_revenue, {STAMP}
        FROM {{o_rides}} WHERE {DONE} GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _(d):
    return marts.mart_surge_analysis(d.rides, now())


SURGED = f"(is_surge AND {DONE})"
CTES["o_driver_stats"] = f"""
SELECT driver_id, count(*) AS total_requests, count(*) FILTER ({DONE}) AS completed_trips,
       count(*) FILTER (ride_status = 'CANCELLED') AS cancelled_trips, {pct(f'count(*) FILTER ({DONE})', 'count(*)')} AS completion_rate_pct,
       {r(f'coalesce(sum({done("total_fare")}), 0)')} AS lifetime_gmv_idr, {r(f'coalesce(sum({done("total_fare")}), 0) * 0.80')} AS lifetime_earnings_idr,
       {done_avg('total_fare', 0)} AS avg_fare_per_trip, {r(f'coalesce(sum({done("distance_km")}), 0)', 2)} AS total_distance_km,
       {done_avg('distance_km', 2)} AS avg_trip_distance_km, {r(f'coalesce(sum({done("duration_minutes")}), 0)')} AS total_online_minutes,
       {r(MINUTES, 2)} AS avg_acceptance_min, {done_avg('passenger_rating', 2)} AS avg_passenger_rating,
       count(*) FILTER {SURGED.replace('(', '(WHERE ', 1)} AS surge_trips_completed,
       {r(avg(f'CASE WHEN {SURGED} THEN surge_multiplier END'), 2)} AS avg_surge_multiplier,
       min(requested_date) AS first_trip_date, max(requested_date) AS last_trip_date,
       (max(requested_date) - min(requested_date))::int AS active_days_span
FROM {{o_rides}} WHERE driver_id IS NOT NULL GROUP BY driver_id
"""
SCORE = """ifnull(s.completion_rate_pct, 0) * 0.4::double + ifnull(s.avg_passenger_rating, 0) * 10::double * 0.4::double
 + least(ifnull(s.completed_trips, 0)::double / 10.0::double, 20.0::double) * 0.2::double"""


@query(
    "mart_driver_performance",
    f"""SELECT d.driver_id, d.driver_name, d.vehicle_type_code, d.vehicle_type_name, d.vehicle_category, d.experience_tier,
        d.driver_status, d.home_zone_code, d.home_zone_name, d.home_city, d.rating::double AS current_rating, d.joined_at,
        s.* EXCLUDE (driver_id), {r(SCORE, 2)} AS performance_score, {STAMP}
        FROM {{o_drivers}} d LEFT JOIN {{o_driver_stats}} s ON s.driver_id = d.driver_id""",
)
def _(d):
    return marts.mart_driver_performance(d.drivers, d.rides, now())


@query("join_dim_to_aggregate", "SELECT d.driver_id, s.total_requests, s.lifetime_gmv_idr FROM {o_drivers} d LEFT JOIN {o_driver_stats} s USING (driver_id)")
def _(d):
    stats = marts.driver_stats(d.rides).select("driver_id", "total_requests", "lifetime_gmv_idr")
    return d.drivers.select("driver_id").join(stats, "driver_id", "left")


ACTIVITY_KEYS = "driver_id, driver_name, vehicle_type_code, vehicle_category, driver_tier, requested_date"
CTES["o_top_zone"] = f"""
SELECT {ACTIVITY_KEYS}, pickup_zone_code FROM (
  SELECT {ACTIVITY_KEYS}, pickup_zone_code,
         row_number() OVER (PARTITION BY {ACTIVITY_KEYS} ORDER BY c DESC, pickup_zone_code ASC NULLS LAST) AS place
  FROM (SELECT {ACTIVITY_KEYS}, pickup_zone_code, count(*) AS c FROM {{o_rides}} WHERE driver_id IS NOT NULL GROUP BY ALL)) WHERE place = 1
"""


@query(
    "mart_driver_daily_activity",
    f"""WITH agg AS (SELECT {ACTIVITY_KEYS}, count(*) AS daily_requests, count(*) FILTER ({DONE}) AS daily_completed,
        count(*) FILTER (ride_status = 'CANCELLED') AS daily_cancelled,
        {r(f'coalesce(sum({done("total_fare")}), 0) * 0.80')} AS daily_earnings_idr, {r(f'coalesce(sum({done("total_fare")}), 0)')} AS daily_gmv_idr,
        {done_avg('total_fare', 0)} AS avg_fare_idr, {r(f'coalesce(sum({done("distance_km")}), 0)', 2)} AS daily_km,
        {r(f'coalesce(sum({done("duration_minutes")}), 0)')} AS daily_trip_minutes,
        count(*) FILTER (WHERE is_surge AND {DONE}) AS surge_trips,
        {r(f'coalesce(sum(CASE WHEN is_surge AND {DONE} THEN {UPLIFT} END), 0)')} AS surge_bonus_idr,
        {done_avg('passenger_rating', 2)} AS daily_avg_rating
        FROM {{o_rides}} WHERE driver_id IS NOT NULL GROUP BY ALL)
        SELECT agg.* EXCLUDE (requested_date), agg.requested_date AS ride_date, z.pickup_zone_code AS primary_zone_code, {STAMP}
        FROM agg JOIN {{o_top_zone}} z ON {' AND '.join(f'z.{k.strip()} IS NOT DISTINCT FROM agg.{k.strip()}' for k in ACTIVITY_KEYS.split(','))}""",
)
def _(d):
    return marts.mart_driver_daily_activity(d.rides, now())


FUNNEL_SQL = f"""
WITH base AS (SELECT (requested_date - dayofweek(requested_date)::int)::date AS week_start, vehicle_type_code, count(*) AS requested,
    count(accepted_at) AS accepted, count(picked_up_at) AS picked_up, count(*) FILTER ({DONE}) AS completed,
    count(*) FILTER (ride_status = 'CANCELLED') AS cancelled, count(*) FILTER (ride_status = 'NO_DRIVER') AS no_driver
    FROM {{o_rides}} WHERE requested_date >= DATE '{NOW[:10]}' - 90 GROUP BY ALL)
SELECT *, {pct('accepted', 'requested', 1)} AS acceptance_rate_pct, {pct('picked_up', 'accepted', 1)} AS pickup_rate_pct,
       {pct('completed', 'picked_up', 1)} AS completion_rate_pct, {pct('completed', 'requested', 1)} AS e2e_conversion_pct
FROM base ORDER BY week_start DESC, vehicle_type_code NULLS FIRST
"""


@query("ride_funnel", FUNNEL_SQL)
def _(d):
    return marts.ride_funnel(d.rides, today())


@query("order_funnel", FUNNEL_SQL.replace("SELECT *,", "SELECT week_start, vehicle_type_code, requested, completed,"))
def _(d):
    out = marts.ride_funnel(d.rides, today())
    return out.select(
        "week_start", "vehicle_type_code", "requested", "completed", "acceptance_rate_pct", "pickup_rate_pct",
        "completion_rate_pct", "e2e_conversion_pct",
    )


# Aggregate functions -------------------------------------------------------------------------------------------------


@query("agg_count_if", f"SELECT pickup_city, count(*) FILTER ({DONE}) AS completed FROM {{o_rides}} GROUP BY ALL")
def _(d):
    return d.rides.groupBy("pickup_city").agg(F.count_if(F.col("ride_status") == "COMPLETED").alias("completed"))


@query(
    "agg_conditional",
    f"""SELECT requested_date, vehicle_category, sum({done('total_fare')})::double AS sum_or_null,
        sum(CASE WHEN {DONE} THEN total_fare ELSE 0 END)::double AS sum_or_zero, max({done('total_fare')})::double AS best
        FROM {{o_rides}} GROUP BY ALL""",
)
def _(d):
    complete, fare = F.col("ride_status") == "COMPLETED", F.col("total_fare")
    return d.rides.groupBy("requested_date", "vehicle_category").agg(
        F.sum(F.when(complete, fare)).alias("sum_or_null"),
        F.sum(F.when(complete, fare).otherwise(F.lit(0).cast("decimal(10,2)"))).alias("sum_or_zero"),
        F.max(F.when(complete, fare)).alias("best"),
    )


@query(
    "agg_top1",
    """SELECT driver_id, requested_date, pickup_zone_code FROM (SELECT driver_id, requested_date, pickup_zone_code,
       row_number() OVER (PARTITION BY driver_id, requested_date ORDER BY c DESC, pickup_zone_code NULLS LAST) AS place
       FROM (SELECT driver_id, requested_date, pickup_zone_code, count(*) AS c FROM {o_rides} GROUP BY ALL)) WHERE place = 1""",
)
def _(d):
    return marts.most_frequent(d.rides, ["driver_id", "requested_date"], "pickup_zone_code")


@query("agg_ratio", f"SELECT pickup_city, time_bucket, {pct(f'count(*) FILTER ({DONE})', 'count(*)')} AS rate FROM {{o_rides}} GROUP BY ALL")
def _(d):
    rate = percent(F.count_if(F.col("ride_status") == "COMPLETED"), F.count("*"))
    return d.rides.groupBy("pickup_city", "time_bucket").agg(rate.alias("rate"))


@query(
    "agg_min_max_span",
    "SELECT driver_id, min(requested_date) AS first_day, max(requested_date) AS last_day, (max(requested_date) - min(requested_date))::int AS span FROM {o_rides} GROUP BY ALL",
)
def _(d):
    first, last = F.min("requested_date"), F.max("requested_date")
    return d.rides.groupBy("driver_id").agg(first.alias("first_day"), last.alias("last_day"), F.datediff(last, first).alias("span"))


@query(
    "agg_ratio_of_sums",
    f"SELECT pickup_city, {pct(f'sum({UPLIFT})', 'sum(total_fare)')} AS uplift_pct, {r('sum(total_fare)::double / nullif(sum(distance_km)::double, 0)', 2)} AS per_km FROM {{o_rides}} WHERE {DONE} GROUP BY ALL",
)
def _(d):
    uplift = F.sum(marts.surge_uplift(F.col("total_fare"), F.col("surge_multiplier")))
    return d.rides.filter("ride_status = 'COMPLETED'").groupBy("pickup_city").agg(
        percent(uplift, F.sum("total_fare")).alias("uplift_pct"),
        round_to(ratio(F.sum("total_fare"), F.sum("distance_km")), 2).alias("per_km"),
    )


@query(
    "agg_pivot_min",
    """SELECT ride_id, min(occurred_at) FILTER (event_type = 'RIDE_REQUESTED') AS "RIDE_REQUESTED",
       min(occurred_at) FILTER (event_type = 'RIDE_ACCEPTED') AS "RIDE_ACCEPTED",
       min(occurred_at) FILTER (event_type = 'PASSENGER_PICKED_UP') AS "PASSENGER_PICKED_UP",
       min(occurred_at) FILTER (event_type = 'RIDE_COMPLETED') AS "RIDE_COMPLETED",
       min(occurred_at) FILTER (event_type = 'RIDE_CANCELLED') AS "RIDE_CANCELLED" FROM {ride_events} GROUP BY ALL""",
)
def _(d):
    from fleetmart.functions.domain import EVENT_TYPES

    return d.table("ride_events").groupBy("ride_id").pivot("event_type", EVENT_TYPES).agg(F.min("occurred_at"))


@query("agg_distinct", "SELECT promo_id, count(DISTINCT passenger_id) AS customers FROM {promo_usage} GROUP BY ALL")
def _(d):
    return d.table("promo_usage").groupBy("promo_id").agg(F.count_distinct("passenger_id").alias("customers"))


@query("agg_distinct_sketch", "SELECT date_trunc('month', requested_at)::date AS month, count(DISTINCT passenger_id) AS customers, true AS within_error FROM {rides} GROUP BY ALL")
def _(d):
    # Sketches are stored per day; the month reads them alone. The exact figure is there to hold them against.
    rides, month = d.table("rides"), lambda c: F.to_date(F.date_trunc("month", c)).alias("month")
    daily = d.stored("daily-sketches", sketches.distinct_sketch(rides, [F.to_date("requested_at").alias("day")], "passenger_id"))
    monthly = sketches.union_distinct(daily, [month("day")])
    exact = rides.groupBy(month("requested_at")).agg(F.count_distinct("passenger_id").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1.0), F.col("customers") * sketches.distinct_error(sigmas=5))
    return exact.join(monthly, "month").select("month", "customers", off.alias("within_error"))


@query(
    "agg_top1_sketch",
    """WITH c AS (SELECT pickup_zone_id, date_trunc('year', requested_at)::date AS year, driver_id, count(*) AS n FROM {rides} WHERE driver_id IS NOT NULL GROUP BY ALL),
       t AS (SELECT pickup_zone_id, year, sum(n) AS rows, arg_max(driver_id, n) AS driver_id, max(n, 2) AS two FROM c GROUP BY ALL)
       SELECT pickup_zone_id, year, rows::bigint AS rows, ceil(rows * 3.5 / 1024)::bigint AS bound, CASE WHEN two[1] - coalesce(two[2], 0) > 2 * ceil(rows * 3.5 / 1024) THEN driver_id END AS driver_id FROM t""",
)
def _(d):
    day = F.to_date("requested_at").alias("day")
    daily = d.stored("daily-tops", sketches.top_sketch(d.table("rides"), ["pickup_zone_id", day], "driver_id"))
    yearly = sketches.union_top(daily, ["pickup_zone_id", F.to_date(F.date_trunc("year", "day")).alias("year")])
    return sketches.clear_winner(sketches.top_values(yearly, 2), "driver_id")


@query(
    "label_cost_rollup",
    """SELECT o_orderpriority AS label_value, sum(o_orderkey * 1024)::bigint AS total_bytes_billed, count(*) AS jobs FROM {orders} GROUP BY ALL""",
)
def _(d):
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    jobs = d.table("orders").select(
        (F.col("o_orderkey") * 1024).alias("total_bytes_billed"),
        F.array(pair("table", F.col("o_orderpriority")), pair("status", F.col("o_orderstatus"))).alias("labels"),
    )
    return marts.label_cost_rollup(jobs, "table")


@query(
    "agg_mean",
    f"SELECT vehicle_category, {r(avg('total_fare'), 4)} AS mean_fare, {r(avg('driver_rating'), 4)} AS mean_rating FROM {{o_rides}} GROUP BY ALL",
)
def _(d):
    return d.rides.groupBy("vehicle_category").agg(
        round_to(mean(F.col("total_fare")), 4).alias("mean_fare"), round_to(mean(F.col("driver_rating")), 4).alias("mean_rating")
    )


