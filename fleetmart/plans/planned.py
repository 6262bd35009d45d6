"""Models the design documents give as schemas only: integer-keyed dimensions, transaction facts and data marts.

Column names follow the schemas; formulas are read off the names. Keys that point to a dimension with one row per natural
key are computed from that key by the same function on both sides and need no join. Drivers and customers have one row
per version, so a fact looks up the version valid at its moment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import calendar, domain
from fleetmart.functions.keys import integer_key
from fleetmart.functions.numbers import mean, ratio, round_to
from fleetmart.operators.history import with_version
from fleetmart.operators.joins import lookup_join

PERCENT = 100.0


def _when_present(key: Column, natural: Column) -> Column:
    return F.when(natural.isNotNull(), key)


def _day_key(ts: Column) -> Column:
    return calendar.date_key(F.to_date(ts))


# Dimensions ----------------------------------------------------------------------------------------------------------


def dim_time(trips: DataFrame) -> DataFrame:
    """All 24 hours, with the number of trips requested in each."""
    counts = trips.groupBy(F.hour("requested_at").cast("long").alias("time_key")).agg(F.count("*").alias("trips"))
    hours = trips.sparkSession.range(24).withColumnRenamed("id", "time_key")
    bucket = domain.time_bucket(F.timestamp_seconds(F.col("time_key") * 3600))
    return hours.join(counts, "time_key", "left").select("time_key", F.col("time_key").alias("hour_num"), bucket.alias("time_bucket"), F.coalesce("trips", F.lit(0)).alias("trips"))


def dim_location(zones: DataFrame) -> DataFrame:
    return zones.select(
        integer_key(F.col("zone_id")).alias("location_key"), "city", F.col("zone_name").alias("area_name"),
        F.col("latitude").cast("double").alias("latitude_center"), F.col("longitude").cast("double").alias("longitude_center"),
    )


def dim_payment_method(payments: DataFrame) -> DataFrame:
    return payments.select(F.col("payment_method")).distinct().select(
        integer_key(F.col("payment_method")).alias("payment_method_key"), F.col("payment_method").alias("payment_method_name")
    )


def dim_trip_status(trips: DataFrame) -> DataFrame:
    status = F.upper("ride_status").alias("trip_status_name")
    return trips.select(status).distinct().select(integer_key(F.col("trip_status_name")).alias("trip_status_key"), "trip_status_name")


def dim_promo(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        integer_key(F.col("promo_id")).alias("promo_key"), F.col("promo_id").cast("string").alias("promo_id"), "promo_code",
        "promo_name", "promo_type", "discount_type", "discount_value", F.to_date("valid_from").alias("start_date"),
        F.to_date("valid_until").alias("end_date"), "budget_amount", "promo_status",
    )


def dim_vehicle(drivers: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """One vehicle per driver, with seats from its type."""
    types = vehicle_types.select(F.col("vehicle_type_id").alias("_type"), F.col("type_name").alias("vehicle_type"), F.col("capacity").alias("seat_capacity"))
    joined = lookup_join(drivers, types, "vehicle_type_id", "_type", "driver_id")
    vehicle = F.concat(F.lit("V-"), "driver_id")
    return joined.select(
        integer_key(vehicle).alias("vehicle_key"), vehicle.alias("vehicle_id"), "driver_id",
        F.col("license_plate").alias("plate_number"), "vehicle_type", F.col("vehicle_brand").alias("brand"),
        F.col("vehicle_model").alias("model"), F.col("vehicle_year").alias("production_year"), "seat_capacity",
    )


def dim_customer(passengers: DataFrame, segments: DataFrame) -> DataFrame:
    """Passenger versions with the segment of the latest snapshot."""
    newest = segments.groupBy("passenger_id").agg(F.max_by("segment_name", "snapshot_date").alias("current_segment"))
    return passengers.join(newest, "passenger_id", "left").select(
        integer_key(F.col("passenger_id"), F.col("valid_from")).alias("customer_key"), F.col("passenger_id").alias("customer_id"),
        F.col("passenger_name").alias("full_name"), "gender", F.col("age_bucket").alias("age_group"),
        F.to_date("registered_at").alias("signup_date"), "email", "phone_number", "current_segment",
        F.col("home_city").alias("city"), "valid_from", "valid_to", "is_current",
    )


def dim_driver(drivers: DataFrame) -> DataFrame:
    return drivers.select(
        integer_key(F.col("driver_id"), F.col("valid_from")).alias("driver_key"), "driver_id", F.col("driver_name").alias("full_name"),
        "driver_status", F.to_date("joined_at").alias("join_date"), F.col("home_city").alias("city"),
        F.col("sim_number").alias("license_number"), "valid_from", "valid_to", "is_current",
    )


def dim_customer_segment(segments: DataFrame) -> DataFrame:
    return segments.select(
        integer_key(F.col("passenger_id"), F.col("snapshot_date")).alias("customer_segment_key"), F.col("passenger_id").alias("customer_id"),
        "segment_name", "segment_score", "snapshot_date",
    )


# Facts ---------------------------------------------------------------------------------------------------------------


def _version_key(rows: DataFrame, history: DataFrame, natural: str, at: str, name: str, spread_by: str) -> DataFrame:
    """``rows`` with the key of the driver or customer version valid at ``at``; ``history`` has one row per version."""
    key = integer_key(F.col(natural), F.col("valid_from"))
    return with_version(rows, history, natural, natural, at, {name: key}, spread_by)


def fct_trip(trips: DataFrame, drivers: DataFrame, customers: DataFrame) -> DataFrame:
    trips = _version_key(trips, drivers, "driver_id", "requested_at", "driver_key", "ride_id")
    trips = _version_key(trips, customers, "passenger_id", "requested_at", "customer_key", "ride_id")
    status = F.upper("ride_status")
    ref = lambda c: _when_present(integer_key(F.col(c)), F.col(c))
    return trips.select(
        integer_key(F.col("ride_id")).alias("trip_key"),
        F.col("ride_id").alias("trip_id"),
        _day_key(F.col("requested_at")).alias("request_date_key"),
        F.hour("requested_at").cast("long").alias("request_time_key"),
        _day_key(F.col("picked_up_at")).alias("pickup_date_key"),
        _day_key(F.col("completed_at")).alias("dropoff_date_key"),
        "customer_key",
        "driver_key",
        ref("vehicle_id").alias("vehicle_key"),
        ref("pickup_zone_id").alias("pickup_location_key"),
        ref("dropoff_zone_id").alias("dropoff_location_key"),
        integer_key(status).alias("trip_status_key"),
        F.col("estimated_distance_km").cast("double").alias("estimated_distance_km"),
        F.col("distance_km").cast("double").alias("actual_distance_km"),
        "estimated_fare",
        F.col("total_fare").alias("actual_fare"),
        F.col("surge_multiplier").cast("double").alias("surge_multiplier"),
        calendar.minutes_between(F.col("picked_up_at"), F.col("completed_at")).alias("trip_duration_minute"),
        calendar.minutes_between(F.col("requested_at"), F.col("picked_up_at")).alias("waiting_time_minute"),
        (status == "COMPLETED").alias("is_completed"),
        (status == "CANCELLED").alias("is_cancelled"),
        "created_at",
        "updated_at",
    )


def fct_payment(payments: DataFrame, customers: DataFrame) -> DataFrame:
    payments = _version_key(payments, customers, "passenger_id", "created_at", "customer_key", "payment_id")
    return payments.select(
        integer_key(F.col("payment_id")).alias("payment_key"), "payment_id", integer_key(F.col("ride_id")).alias("trip_key"),
        "customer_key", _day_key(F.col("created_at")).alias("payment_date_key"),
        integer_key(F.col("payment_method")).alias("payment_method_key"), F.col("amount").alias("gross_amount"),
        F.col("promo_discount").alias("discount_amount"), "tax_amount", "toll_amount", "tip_amount", "net_amount", "payment_status",
        F.col("paid_at").alias("paid_ts"), "created_at", "updated_at",
    )


def fct_driver_payout(payouts: DataFrame, drivers: DataFrame) -> DataFrame:
    payouts = _version_key(payouts, drivers, "driver_id", "created_at", "driver_key", "payout_id")
    return payouts.select(
        integer_key(F.col("payout_id")).alias("payout_key"), "payout_id", integer_key(F.col("ride_id")).alias("trip_key"),
        "driver_key", calendar.date_key(F.col("payout_date")).alias("payout_date_key"),
        "base_earning", "incentive_amount", "bonus_amount", "deduction_amount", "final_payout_amount", "payout_status",
        "created_at", "updated_at",
    )


def fct_rating(trips: DataFrame, drivers: DataFrame, customers: DataFrame) -> DataFrame:
    """Passenger ratings of completed trips."""
    rated = trips.filter("passenger_rating IS NOT NULL")
    rated = _version_key(rated, drivers, "driver_id", "completed_at", "driver_key", "ride_id")
    rated = _version_key(rated, customers, "passenger_id", "completed_at", "customer_key", "ride_id")
    return rated.select(
        integer_key(F.lit("rating"), F.col("ride_id")).alias("rating_key"), F.concat(F.lit("RT-"), "ride_id").alias("rating_id"),
        integer_key(F.col("ride_id")).alias("trip_key"), "customer_key", "driver_key", _day_key(F.col("completed_at")).alias("rating_date_key"),
        F.round("passenger_rating", 0).cast("long").alias("rating_score"), F.col("notes").isNotNull().alias("has_review_text"),
        F.col("completed_at").alias("rated_ts"), F.col("completed_at").alias("created_at"), "updated_at",
    )


def fct_promo_redemption(usage: DataFrame, customers: DataFrame) -> DataFrame:
    usage = _version_key(usage, customers, "passenger_id", "used_at", "customer_key", "usage_id")
    return usage.select(
        integer_key(F.col("usage_id")).alias("promo_redemption_key"), F.col("usage_id").alias("redemption_id"),
        integer_key(F.col("promo_id")).alias("promo_key"), integer_key(F.col("ride_id")).alias("trip_key"),
        "customer_key", _day_key(F.col("used_at")).alias("redemption_date_key"),
        F.col("discount_given").alias("discount_amount"), "redemption_status", F.col("used_at").alias("redeemed_ts"), "created_at",
        "updated_at",
    )


def star_orphans(facts: dict[str, DataFrame], dimensions: dict[str, DataFrame]) -> DataFrame:
    """(fact, key, rows, orphans): for every key of a fact that a dimension has, its rows with a key and those without a dimension row."""
    out = None
    for fact, rows in facts.items():
        for key, dim in dimensions.items():
            if key in rows.columns:
                known = dim.select(F.col(key).alias("_known"), F.lit(True).alias("_there"))
                met = lookup_join(rows.select(key).where(F.col(key).isNotNull()), known, key, "_known")
                part = met.agg(F.count("*").alias("rows"), F.count_if(F.col("_there").isNull()).alias("orphans")).select(F.lit(fact).alias("fact"), F.lit(key).alias("key"), "rows", "orphans")
                out = part if out is None else out.unionByName(part)
    return out


# Marts ---------------------------------------------------------------------------------------------------------------


def _status(name: str) -> Column:
    return F.col("ride_status") == name


def _rate(part: Column, whole: Column) -> Column:
    return round_to(ratio(part, whole) * PERCENT, 2)


def dm_trip_daily_city(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Per day and pickup city, from the trips and the zone dimension alone."""
    city = zones.select(F.col("zone_id").alias("_zone"), "city")
    placed = lookup_join(trips.withColumn("ride_status", F.upper("ride_status")), city, "pickup_zone_id", "_zone", "ride_id")
    waiting = calendar.minutes_between(F.col("requested_at"), F.col("picked_up_at"))
    riding = calendar.minutes_between(F.col("picked_up_at"), F.col("completed_at"))
    return placed.groupBy(_day_key(F.col("requested_at")).alias("date_key"), "city").agg(
        F.count("*").alias("total_trip_requested"),
        F.count_if(_status("COMPLETED")).alias("total_trip_completed"),
        F.count_if(_status("CANCELLED")).alias("total_trip_cancelled"),
        _rate(F.count_if(_status("COMPLETED")), F.count("*")).alias("completion_rate"),
        _rate(F.count_if(_status("CANCELLED")), F.count("*")).alias("cancellation_rate"),
        round_to(mean(F.col("estimated_distance_km")), 2).alias("avg_estimated_distance_km"),
        round_to(mean(F.when(_status("COMPLETED"), F.col("distance_km"))), 2).alias("avg_actual_distance_km"),
        round_to(mean(riding), 2).alias("avg_trip_duration_minute"),
        round_to(mean(waiting), 2).alias("avg_waiting_time_minute"),
        round_to(mean(F.when(_status("COMPLETED"), F.col("total_fare"))), 2).alias("avg_actual_fare"),
    )


def dm_trip_hourly_city(rides: DataFrame) -> DataFrame:
    keys = [calendar.date_key(F.col("requested_date")).alias("date_key"), F.hour("requested_at").cast("long").alias("time_key"), F.col("pickup_city").alias("city")]
    return rides.groupBy(*keys).agg(
        F.count("*").alias("total_trip_requested"),
        F.count_if(_status("COMPLETED")).alias("total_trip_completed"),
        F.count_if(_status("CANCELLED")).alias("total_trip_cancelled"),
        round_to(mean(F.col("surge_multiplier")), 3).alias("avg_surge_multiplier"),
    )


PAYMENT_SUMS = {
    "total_gross_amount": "amount",
    "total_discount_amount": "promo_discount",
    "total_tax_amount": "tax_amount",
    "total_toll_amount": "toll_amount",
    "total_tip_amount": "tip_amount",
    "total_net_amount": "net_amount",
}


def dm_finance_daily_city(payments: DataFrame, payouts: DataFrame, trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Payments and payouts, each summed per trip, meet the trips once; then day and city totals."""
    paid = payments.filter("payment_status = 'SUCCESS'").groupBy("ride_id").agg(*[F.sum(c).alias(c) for c in PAYMENT_SUMS.values()])
    out = payouts.groupBy("ride_id").agg(F.sum("final_payout_amount").alias("payout"))
    city = zones.select(F.col("zone_id").alias("_zone"), "city")
    rows = trips.select("ride_id", "requested_at", "pickup_zone_id", F.upper("ride_status").alias("ride_status"))
    joined = lookup_join(rows.join(paid, "ride_id", "left").join(out, "ride_id", "left"), city, "pickup_zone_id", "_zone", "ride_id")
    money = lambda c: F.coalesce(F.sum(c), F.lit(0))
    done = F.count_if(_status("COMPLETED"))
    return joined.groupBy(_day_key(F.col("requested_at")).alias("date_key"), "city").agg(
        *[round_to(money(column), 2).alias(name) for name, column in PAYMENT_SUMS.items()],
        round_to(money("payout"), 2).alias("total_driver_payout"),
        round_to(money("net_amount") - money("payout"), 2).alias("estimated_platform_revenue"),
        done.alias("completed_trip_count"),
        round_to(ratio(money("net_amount"), done), 2).alias("avg_revenue_per_trip"),
    )


def dm_payment_method_daily(payments: DataFrame) -> DataFrame:
    net = F.col("net_amount")
    keys = [_day_key(F.col("created_at")).alias("date_key"), F.col("payment_method").alias("payment_method_name")]
    return payments.groupBy(*keys).agg(
        F.count("*").alias("payment_count"),
        round_to(F.sum(net), 2).alias("total_net_amount"),
        round_to(mean(net), 2).alias("avg_net_amount"),
        F.count_if(F.col("payment_status") == "SUCCESS").alias("success_payment_count"),
        F.count_if(F.col("payment_status") == "FAILED").alias("failed_payment_count"),
    )


def dm_promo_daily(usage: DataFrame, promotions: DataFrame, rides: DataFrame) -> DataFrame:
    """Redemptions per day and promo. Distinct customers and trips are made distinct before the final count."""
    status = rides.select(F.col("ride_id").alias("_ride"), (F.upper("ride_status") == "COMPLETED").alias("_done"))
    names = promotions.select(F.col("promo_id").alias("_promo"), "promo_code", "promo_name")
    joined = lookup_join(lookup_join(usage, status, "ride_id", "_ride", "usage_id"), names, "promo_id", "_promo", "usage_id")
    return joined.groupBy(_day_key(F.col("used_at")).alias("date_key"), "promo_code", "promo_name").agg(
        F.count("*").alias("total_redemption"),
        round_to(F.sum("discount_given"), 2).alias("total_discount_amount"),
        F.count_distinct("passenger_id").alias("unique_customer_count"),
        F.count_distinct("ride_id").alias("total_trip_count"),
        F.count_distinct(F.when(F.col("_done"), F.col("ride_id"))).alias("completed_trip_count"),
    )


def dm_campaign_daily_channel(spend: DataFrame) -> DataFrame:
    keys = [calendar.date_key(F.col("spend_date")).alias("date_key"), "channel_name", "campaign_name"]
    return spend.groupBy(*keys).agg(
        round_to(F.sum("spend_amount"), 2).alias("spend_amount"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("installs").alias("installs"),
        round_to(ratio(F.sum("clicks"), F.sum("impressions")), 4).alias("ctr"),
        round_to(ratio(F.sum("spend_amount"), F.sum("installs")), 2).alias("cpi"),
    )


def dm_customer_segment_daily(segments: DataFrame) -> DataFrame:
    return segments.groupBy("snapshot_date", "segment_name").agg(
        F.count_distinct("passenger_id").alias("customer_count"), round_to(mean(F.col("segment_score")), 2).alias("avg_segment_score")
    )


def _driver_period(rides: DataFrame, payouts: DataFrame, period: Column) -> DataFrame:
    paid = payouts.groupBy("ride_id").agg(
        F.sum("final_payout_amount").alias("payout"), F.sum("bonus_amount").alias("bonus"), F.sum("incentive_amount").alias("incentive")
    )
    trips = rides.filter("driver_id IS NOT NULL").select(
        "ride_id", "driver_id", period.alias("period"), F.col("pickup_city").alias("city"), "ride_status", "passenger_rating", "distance_km", "total_fare"
    )
    return trips.join(paid, "ride_id", "left").groupBy("period", "driver_id", "city")


def dm_driver_daily_performance(rides: DataFrame, payouts: DataFrame) -> DataFrame:
    done = _status("COMPLETED")
    out = _driver_period(rides, payouts, calendar.date_key(F.col("requested_date"))).agg(
        F.count("*").alias("total_trip_assigned"),
        F.count_if(done).alias("total_trip_completed"),
        F.count_if(_status("CANCELLED")).alias("total_trip_cancelled"),
        _rate(F.count_if(done), F.count("*")).alias("completion_rate"),
        round_to(mean(F.col("passenger_rating")), 2).alias("avg_rating_score"),
        round_to(F.coalesce(F.sum(F.when(done, F.col("distance_km"))), F.lit(0)), 2).alias("total_actual_distance_km"),
        round_to(F.coalesce(F.sum(F.when(done, F.col("total_fare"))), F.lit(0)), 2).alias("total_working_revenue"),
        round_to(F.coalesce(F.sum("payout"), F.lit(0)), 2).alias("total_payout_amount"),
    )
    return out.withColumnRenamed("period", "date_key")


def dm_driver_monthly_summary(rides: DataFrame, payouts: DataFrame) -> DataFrame:
    out = _driver_period(rides, payouts, F.date_format("requested_date", "yyyyMM")).agg(
        F.count_if(_status("COMPLETED")).alias("total_trip_completed"),
        round_to(mean(F.col("passenger_rating")), 2).alias("avg_rating_score"),
        round_to(F.coalesce(F.sum("payout"), F.lit(0)), 2).alias("total_payout_amount"),
        round_to(F.coalesce(F.sum("bonus"), F.lit(0)), 2).alias("total_bonus_amount"),
        round_to(F.coalesce(F.sum("incentive"), F.lit(0)), 2).alias("total_incentive_amount"),
    )
    return out.withColumnRenamed("period", "month_key")


def between_days(source: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Source rows whose time falls on the days of a key range; the column stays bare, so the bounds reach a stored table's scan."""
    first, last = (F.to_date(F.lit(str(k)), "yyyyMMdd") for k in (low, high))
    return source.filter((F.col(column) >= first.cast("timestamp")) & (F.col(column) < F.date_add(last, 1).cast("timestamp")))


def date_key_range(mart: DataFrame, low: int, high: int, column: str = "date_key") -> DataFrame:
    return mart.filter(F.col(column).between(low, high))
