"""Business marts over the ride fact. Each is one hash aggregation with partial aggregation before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import calendar
from fleetmart.functions.numbers import mean, percent, ratio, round_to
from fleetmart.operators.dedup import top_per_group

# Revenue split, score weights and surge steps.
PLATFORM_SHARE = 0.20
DRIVER_SHARE = 0.80
SCORE_WEIGHT_COMPLETION = 0.4
SCORE_WEIGHT_RATING = 0.4
SCORE_WEIGHT_VOLUME = 0.2
SCORE_VOLUME_CAP = 20.0
SURGE_STEPS = [("flat_trips", "1.0"), ("surge_12x_trips", "1.2"), ("surge_15x_trips", "1.5"), ("surge_20x_trips", "2.0")]
FUNNEL_DAYS = 90

COMPLETED = "COMPLETED"
CANCELLED = "CANCELLED"
NO_DRIVER = "NO_DRIVER"


def _is(status: str) -> Column:
    return F.col("ride_status") == status


def _done(column: str | Column) -> Column:
    """The column on completed rides, NULL elsewhere."""
    return F.when(_is(COMPLETED), F.col(column) if isinstance(column, str) else column)


def _done_or_zero(column: str) -> Column:
    """Total over completed rides, 0 for a group without one."""
    return F.coalesce(F.sum(_done(column)), F.lit(0))


def _stamp(df: DataFrame, now: Column | None) -> DataFrame:
    return df if now is None else df.withColumn("refreshed_at", now)


def _mean_minutes(seconds: Column) -> Column:
    return ratio(F.sum(seconds), F.count(seconds)) / F.lit(60.0)


def surge_uplift(fare: Column, multiplier: Column) -> Column:
    """What the multiplier added to a fare, in a decimal so the sum is exact."""
    return (fare.cast("double") - F.try_divide(fare.cast("double"), multiplier.cast("double"))).cast("decimal(18,6)")


def mart_daily_ride_summary(rides: DataFrame, now: Column | None = None) -> DataFrame:
    total = F.count("*")
    keys = [
        F.col("requested_date").alias("ride_date"), "vehicle_type_code", "vehicle_type_name", "vehicle_category",
        "pickup_city", "pickup_province", "pickup_area_type", "time_bucket",
    ]
    out = rides.groupBy(*keys).agg(
        total.alias("total_requests"),
        F.count_if(_is(COMPLETED)).alias("completed_rides"),
        F.count_if(_is(CANCELLED)).alias("cancelled_rides"),
        F.count_if(_is(NO_DRIVER)).alias("no_driver_rides"),
        F.count_if(F.col("ride_status").isin("ACCEPTED", "PICKED_UP")).alias("in_progress_rides"),
        percent(F.count_if(_is(COMPLETED)), total).alias("completion_rate_pct"),
        percent(F.count_if(_is(CANCELLED)), total).alias("cancellation_rate_pct"),
        percent(F.count_if(F.col("is_surge")), total).alias("surge_rate_pct"),
        round_to(F.sum(_done("total_fare"))).alias("gross_revenue_idr"),
        round_to(mean(_done("total_fare"))).alias("avg_fare_idr"),
        round_to(F.max(_done("total_fare"))).alias("max_fare_idr"),
        round_to(F.sum(_done("promo_discount"))).alias("total_promo_idr"),
        round_to(mean(_done("distance_km")), 2).alias("avg_distance_km"),
        round_to(F.sum(_done("distance_km")), 2).alias("total_distance_km"),
        round_to(mean(_done("duration_minutes")), 1).alias("avg_trip_minutes"),
        round_to(_mean_minutes(F.col("acceptance_duration_secs")), 1).alias("avg_acceptance_minutes"),
        round_to(mean(_done("driver_rating")), 2).alias("avg_driver_rating"),
        round_to(mean(_done("passenger_rating")), 2).alias("avg_passenger_rating"),
        F.count_if(F.col("has_promo") & _is(COMPLETED)).alias("promo_rides_count"),
    )
    return _stamp(out, now)


def mart_zone_heatmap(rides: DataFrame, now: Column | None = None) -> DataFrame:
    """Origin-destination counts of completed rides, one row per pair and time bucket."""
    keys = [
        F.col("requested_date").alias("ride_date"), "pickup_zone_code", "pickup_zone_name", "pickup_city",
        "pickup_province", "pickup_area_type", "dropoff_zone_code", "dropoff_zone_name", "is_same_zone_trip",
        "time_bucket",
    ]
    out = rides.filter(_is(COMPLETED)).groupBy(*keys).agg(
        F.count("*").alias("trip_count"),
        round_to(F.sum("total_fare")).alias("total_fare_idr"),
        round_to(mean(F.col("total_fare"))).alias("avg_fare_idr"),
        round_to(mean(F.col("distance_km")), 2).alias("avg_distance_km"),
        round_to(mean(F.col("duration_minutes")), 1).alias("avg_duration_min"),
        F.count_if("is_surge").alias("surge_trip_count"),
        round_to(mean(F.col("surge_multiplier")), 2).alias("avg_surge_multiplier"),
    )
    return _stamp(out, now)


def mart_cancellation_analysis(rides: DataFrame, now: Column | None = None) -> DataFrame:
    wait = F.col("acceptance_duration_secs")
    keys = [
        F.col("requested_date").alias("ride_date"),
        F.coalesce("cancellation_reason", F.lit("Unknown")).alias("cancellation_reason"),
        "vehicle_type_code", "vehicle_type_name", "pickup_zone_code", "pickup_zone_name", "pickup_city", "time_bucket",
    ]
    out = rides.filter(F.col("ride_status").isin(CANCELLED, NO_DRIVER)).groupBy(*keys).agg(
        F.count("*").alias("cancelled_count"),
        F.count_if(wait.isNull()).alias("no_acceptance_count"),
        F.count_if(wait.isNotNull()).alias("post_acceptance_count"),
        round_to(_mean_minutes(wait), 2).alias("avg_time_to_accept_min"),
    )
    return _stamp(out, now)


def mart_revenue_daily(rides: DataFrame, now: Column | None = None) -> DataFrame:
    keys = [F.col("requested_date").alias("ride_date"), "vehicle_category", "fare_tier", "vehicle_type_code", "pickup_province"]
    fare, promo = F.sum("total_fare"), F.sum("promo_discount")
    platform, driver = F.lit(PLATFORM_SHARE).cast("decimal(3,2)"), F.lit(DRIVER_SHARE).cast("decimal(3,2)")
    out = rides.filter(_is(COMPLETED)).groupBy(*keys).agg(
        F.count("*").alias("completed_trips"),
        F.count_if("is_surge").alias("surge_trips"),
        F.count_if("has_promo").alias("promo_trips"),
        round_to(fare).alias("gmv_idr"),
        round_to(mean(F.col("total_fare"))).alias("avg_gmv_per_trip"),
        round_to(F.sum("base_fare")).alias("total_base_fare"),
        round_to(F.sum("distance_fare")).alias("total_distance_fare"),
        round_to(F.sum("time_fare")).alias("total_time_fare"),
        round_to(F.sum(surge_uplift(F.col("total_fare"), F.col("surge_multiplier")))).alias("surge_uplift_idr"),
        round_to(promo).alias("promo_discount_idr"),
        round_to(fare * platform).alias("platform_revenue_idr"),
        round_to(fare * driver).alias("driver_earnings_idr"),
        round_to(fare * platform - promo).alias("net_platform_revenue_idr"),
        round_to(ratio(fare, F.sum("distance_km"))).alias("revenue_per_km"),
    )
    return _stamp(out, now)


def mart_surge_analysis(rides: DataFrame, now: Column | None = None) -> DataFrame:
    keys = [
        F.col("requested_date").alias("ride_date"), "time_bucket", "pickup_zone_code", "pickup_zone_name", "pickup_city",
        "vehicle_type_code",
    ]
    mult = F.col("surge_multiplier")
    uplift = F.sum(surge_uplift(F.col("total_fare"), mult))
    steps = [F.count_if(mult == F.lit(step).cast("decimal(4,2)")).alias(name) for name, step in SURGE_STEPS]
    out = rides.filter(_is(COMPLETED)).groupBy(*keys).agg(
        *steps,
        F.count("*").alias("total_trips"),
        round_to(mean(mult), 3).alias("avg_surge_multiplier"),
        round_to(F.max(mult), 2).alias("peak_surge_multiplier"),
        round_to(uplift).alias("surge_incremental_idr"),
        round_to(F.sum("total_fare")).alias("total_fare_idr"),
        percent(uplift, F.sum("total_fare")).alias("surge_pct_of_revenue"),
    )
    return _stamp(out, now)


def driver_stats(rides: DataFrame) -> DataFrame:
    """Lifetime figures per driver id."""
    surged = F.col("is_surge") & _is(COMPLETED)
    first, last = F.min("requested_date"), F.max("requested_date")
    return rides.filter(F.col("driver_id").isNotNull()).groupBy("driver_id").agg(
        F.count("*").alias("total_requests"),
        F.count_if(_is(COMPLETED)).alias("completed_trips"),
        F.count_if(_is(CANCELLED)).alias("cancelled_trips"),
        percent(F.count_if(_is(COMPLETED)), F.count("*")).alias("completion_rate_pct"),
        round_to(_done_or_zero("total_fare")).alias("lifetime_gmv_idr"),
        round_to(_done_or_zero("total_fare") * F.lit(DRIVER_SHARE).cast("decimal(3,2)")).alias("lifetime_earnings_idr"),
        round_to(mean(_done("total_fare"))).alias("avg_fare_per_trip"),
        round_to(_done_or_zero("distance_km"), 2).alias("total_distance_km"),
        round_to(mean(_done("distance_km")), 2).alias("avg_trip_distance_km"),
        round_to(_done_or_zero("duration_minutes")).alias("total_online_minutes"),
        round_to(_mean_minutes(F.col("acceptance_duration_secs")), 2).alias("avg_acceptance_min"),
        round_to(mean(_done("passenger_rating")), 2).alias("avg_passenger_rating"),
        F.count_if(surged).alias("surge_trips_completed"),
        round_to(mean(F.when(surged, F.col("surge_multiplier"))), 2).alias("avg_surge_multiplier"),
        first.alias("first_trip_date"),
        last.alias("last_trip_date"),
        F.datediff(last, first).alias("active_days_span"),
    )


def performance_score(completion_pct: Column, rating: Column, completed: Column) -> Column:
    volume = F.least(F.coalesce(completed, F.lit(0)).cast("double") / 10.0, F.lit(SCORE_VOLUME_CAP))
    score = (
        F.coalesce(completion_pct, F.lit(0.0)) * SCORE_WEIGHT_COMPLETION
        + F.coalesce(rating, F.lit(0.0)) * 10 * SCORE_WEIGHT_RATING
        + volume * SCORE_WEIGHT_VOLUME
    )
    return round_to(score, 2)


def mart_driver_performance(drivers: DataFrame, rides: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per current driver; rides are reduced to one row per driver before the join."""
    dim = drivers.filter("is_current").select(
        "driver_id", "driver_name", "vehicle_type_code", "vehicle_type_name", "vehicle_category", "experience_tier",
        "driver_status", "home_zone_code", "home_zone_name", "home_city", F.col("rating").alias("current_rating"),
        "joined_at",
    )
    out = dim.join(driver_stats(rides), "driver_id", "left").withColumn(
        "performance_score",
        performance_score(F.col("completion_rate_pct"), F.col("avg_passenger_rating"), F.col("completed_trips")),
    )
    return _stamp(out, now)


def mart_driver_daily_activity(rides: DataFrame, now: Column | None = None) -> DataFrame:
    """Per driver and day. Rides are first reduced per pickup zone; the day's figures and its most frequent zone both
    come from that small table, so the fact is shuffled once.
    """
    keys = ["driver_id", "driver_name", "vehicle_type_code", "vehicle_category", "driver_tier", "requested_date"]
    surged = F.col("is_surge") & _is(COMPLETED)
    per_zone = rides.filter(F.col("driver_id").isNotNull()).groupBy(*keys, "pickup_zone_code").agg(
        F.count("*").alias("n"),
        F.count_if(_is(COMPLETED)).alias("done"),
        F.count_if(_is(CANCELLED)).alias("cancelled"),
        F.sum(_done("total_fare")).alias("fare"),
        F.sum(_done("distance_km")).alias("km"),
        F.sum(_done("duration_minutes")).alias("minutes"),
        F.count_if(surged).alias("surged"),
        F.sum(F.when(surged, surge_uplift(F.col("total_fare"), F.col("surge_multiplier")))).alias("bonus"),
        F.sum(_done("passenger_rating")).alias("stars"),
        F.count(_done("passenger_rating")).alias("rated"),
    )
    # Most rides first; on a tie a known zone before NULL, then the smaller code.
    zone_rank = F.struct((-F.col("n")).alias("n"), F.col("pickup_zone_code").isNull().alias("unknown"), "pickup_zone_code")
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("fare", "km", "minutes", "bonus")}
    out = per_zone.groupBy(*keys).agg(
        F.sum("n").alias("daily_requests"),
        F.sum("done").alias("daily_completed"),
        F.sum("cancelled").alias("daily_cancelled"),
        round_to(total["fare"] * F.lit(DRIVER_SHARE).cast("decimal(3,2)")).alias("daily_earnings_idr"),
        round_to(total["fare"]).alias("daily_gmv_idr"),
        round_to(ratio(F.sum("fare"), F.sum("done"))).alias("avg_fare_idr"),
        round_to(total["km"], 2).alias("daily_km"),
        round_to(total["minutes"]).alias("daily_trip_minutes"),
        F.sum("surged").alias("surge_trips"),
        round_to(total["bonus"]).alias("surge_bonus_idr"),
        round_to(ratio(F.sum("stars"), F.sum("rated")), 2).alias("daily_avg_rating"),
        F.min_by("pickup_zone_code", zone_rank).alias("primary_zone_code"),
    )
    return _stamp(out.withColumnRenamed("requested_date", "ride_date"), now)


def ride_funnel(rides: DataFrame, today: Column, days: int = FUNNEL_DAYS) -> DataFrame:
    """Weekly conversion by vehicle type, newest week first."""
    week = calendar.week_start_sunday(F.col("requested_date")).alias("week_start")
    base = rides.filter(F.col("requested_date") >= F.date_sub(today, days)).groupBy(week, "vehicle_type_code").agg(
        F.count("*").alias("requested"),
        F.count("accepted_at").alias("accepted"),
        F.count("picked_up_at").alias("picked_up"),
        F.count_if(_is(COMPLETED)).alias("completed"),
        F.count_if(_is(CANCELLED)).alias("cancelled"),
        F.count_if(_is(NO_DRIVER)).alias("no_driver"),
    )

    def rate(part: str, whole: str) -> Column:
        return percent(F.col(part), F.col(whole), 1)

    return base.withColumns(
        {
            "acceptance_rate_pct": rate("accepted", "requested"),
            "pickup_rate_pct": rate("picked_up", "accepted"),
            "completion_rate_pct": rate("completed", "picked_up"),
            "e2e_conversion_pct": rate("completed", "requested"),
        }
    ).orderBy(F.desc("week_start"), F.asc("vehicle_type_code"))


def most_frequent(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The most frequent value per group, NULL included; the exact form of an approximate top-1."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    return top_per_group(counts, group, value, "_n")


def label_cost_rollup(jobs: DataFrame, label_key: str) -> DataFrame:
    """Billed bytes by the value of one label; ``labels`` is an array of (key, value)."""
    labels = jobs.select("total_bytes_billed", F.explode("labels").alias("label"))
    return labels.filter(F.col("label.key") == label_key).groupBy(F.col("label.value").alias("label_value")).agg(
        F.sum("total_bytes_billed").alias("total_bytes_billed"), F.count("*").alias("jobs")
    )
