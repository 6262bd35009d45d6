"""Business rules of the ride flow as column jobs: fares, demand, surge, distance, duration, positions, backlog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.domain import TERMINAL_STATUSES
from fleetmart.functions.numbers import round_to
from fleetmart.operators.joins import lookup_join

# Fare floor; demand level by hour span [from, to); weekend uplift; surge and speed parameters.
MINIMUM_FARE = "7000.00"
DEMAND_BY_HOUR = [(6, 9, 1.8), (9, 11, 1.2), (11, 14, 1.4), (14, 16, 1.0), (16, 20, 2.1), (20, 23, 1.6)]
DEMAND_ELSE = 0.6
DEMAND_FLOOR = 0.3
WEEKEND_UPLIFT_HOURS = (10, 22)
WEEKEND_UPLIFT_DAY = 0.3
WEEKEND_UPLIFT_NIGHT = 0.1
RUSH_HOURS = [7, 8, 17, 18, 19]
BUSY_ZONES = ["KWN", "JKT-PUS", "JKT-SEL", "BSD"]
BUSY_ZONE_UPLIFT = 0.08
RUSH_HOUR_UPLIFT = 0.12
SURGE_DIVISOR = 1.4
SURGE_FLOOR = 1.0
SURGE_CAP = 2.2
KM_PER_DEGREE = 111
MIDDAY_HOURS = [10, 11, 12, 13, 14]
SPEED_RUSH, SPEED_MIDDAY, SPEED_NIGHT, SPEED_ELSE = 18.0, 24.0, 35.0, 28.0
MINIMUM_MINUTES = 6
RIDE_CODE_PATTERN = r"^RIDE-(\d{8})-(\d{6})$"
LONG_CODE_PATTERN = r"^RIDE-[0-9]{8}-[0-9]{6,18}$"
#: Characters before the number.
CODE_HEAD = 14
LOOKBACK_DAYS = 14


def recompute_fare(rides: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """Fare by the rate card next to the stored one."""
    card = vehicle_types.select(
        F.col("vehicle_type_id").alias("_type"), F.col("base_fare").alias("_base"), F.col("per_km_rate").alias("_km"),
        F.col("per_minute_rate").alias("_min"),
    )
    joined = lookup_join(rides, card, "vehicle_type_id", "_type", "ride_id")
    money = lambda c: c.cast("decimal(10,2)")
    metered = F.col("_base") + money(F.col("_km") * F.col("distance_km")) + money(F.col("_min") * F.col("duration_minutes"))
    surge = F.coalesce(F.col("surge_multiplier"), F.lit(1).cast("decimal(4,2)"))
    due = metered * surge - F.coalesce(F.col("promo_discount"), F.lit(0).cast("decimal(10,2)"))
    expected = F.when(due.isNotNull(), F.greatest(F.lit(MINIMUM_FARE).cast("decimal(12,2)"), due.cast("decimal(12,2)")))
    return joined.withColumn("expected_fare", expected.cast("decimal(12,2)")).select(
        "ride_id", "total_fare", "expected_fare", (F.col("total_fare") - F.col("expected_fare")).alias("difference")
    )


def _hour_class(hour: Column, spans: list[tuple[int, int, float]], otherwise: float) -> Column:
    expr = F
    for low, high, value in spans:
        expr = expr.when((hour >= low) & (hour < high), value)
    return expr.otherwise(otherwise)


def demand_level(ts: Column) -> Column:
    """Demand by hour and weekend, without the random part."""
    hour, weekend = F.hour(ts), F.dayofweek(ts).isin(1, 7)
    low, high = WEEKEND_UPLIFT_HOURS
    uplift = F.when((hour >= low) & (hour < high), WEEKEND_UPLIFT_DAY).otherwise(WEEKEND_UPLIFT_NIGHT)
    level = _hour_class(hour, DEMAND_BY_HOUR, DEMAND_ELSE) + F.when(weekend, uplift).otherwise(0.0)
    return F.greatest(F.lit(DEMAND_FLOOR), F.round(level, 2))


def demand_band(rides: DataFrame) -> DataFrame:
    """Rides per demand level."""
    return rides.groupBy(demand_level(F.col("requested_at")).alias("demand")).agg(
        F.count("*").alias("rides"), F.count_if(F.upper("ride_status") == "COMPLETED").alias("completed")
    )


def surge_reference(rides: DataFrame, zones: DataFrame, busy_zones: list[str] = BUSY_ZONES) -> DataFrame:
    """Reference multiplier from demand, zone and hour, next to the charged one."""
    codes = zones.select(F.col("zone_id").alias("_zone"), F.col("zone_code").alias("pickup_zone_code"))
    joined = lookup_join(rides, codes, "pickup_zone_id", "_zone", "ride_id")
    ts = F.col("requested_at")
    rush = (
        F.lit(1.0)
        + F.when(F.col("pickup_zone_code").isin(busy_zones), BUSY_ZONE_UPLIFT).otherwise(0.0)
        + F.when(F.hour(ts).isin(RUSH_HOURS), RUSH_HOUR_UPLIFT).otherwise(0.0)
    )
    raw = demand_level(ts) * rush / SURGE_DIVISOR
    reference = round_to(F.least(F.lit(SURGE_CAP), F.greatest(F.lit(SURGE_FLOOR), raw)), 2)
    return joined.select("ride_id", "pickup_zone_code", reference.alias("reference_multiplier"), "surge_multiplier")


def _degrees_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    north, east = lat1.cast("double") - lat2.cast("double"), lon1.cast("double") - lon2.cast("double")
    return F.sqrt(north * north + east * east) * KM_PER_DEGREE


def zone_distance(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Planar centroid distance for every pickup and dropoff pair seen; rides are reduced to pairs first."""
    pairs = rides.groupBy("pickup_zone_id", "dropoff_zone_id").agg(F.count("*").alias("rides"))
    side = lambda p: zones.select(F.col("zone_id").alias("_z"), F.col("latitude").alias(f"{p}_lat"), F.col("longitude").alias(f"{p}_lon"))
    placed = lookup_join(lookup_join(pairs, side("_a"), "pickup_zone_id", "_z"), side("_b"), "dropoff_zone_id", "_z")
    km = _degrees_km(F.col("_a_lat"), F.col("_a_lon"), F.col("_b_lat"), F.col("_b_lon"))
    return placed.select("pickup_zone_id", "dropoff_zone_id", "rides", round_to(km, 3).alias("centroid_km"))


def band_speed(ts: Column) -> Column:
    hour = F.hour(ts)
    return (
        F.when(hour.isin(RUSH_HOURS), SPEED_RUSH)
        .when(hour.isin(MIDDAY_HOURS), SPEED_MIDDAY)
        .when((hour >= 22) | (hour <= 4), SPEED_NIGHT)
        .otherwise(SPEED_ELSE)
    )


def expected_duration(rides: DataFrame) -> DataFrame:
    """Minutes expected from distance and the hour's speed, and the mean deviation per speed class."""
    minutes = F.col("distance_km").cast("double") / band_speed(F.col("requested_at")) * 60
    expected = F.greatest(F.lit(MINIMUM_MINUTES), round_to(minutes, 0).cast("long"))
    rows = rides.filter("distance_km IS NOT NULL AND duration_minutes IS NOT NULL").select(
        band_speed(F.col("requested_at")).alias("speed_kmh"), (F.col("duration_minutes") - expected).alias("off")
    )
    return rows.groupBy("speed_kmh").agg(
        F.count("*").alias("rides"), round_to(F.sum("off").cast("double") / F.count("*"), 3).alias("mean_deviation_min")
    )


def ping_zone(pings: DataFrame, rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone and position of each ping of an active ride from its progress between the ride's two zones.

    ``pings`` carry ``ride_id`` and ``progress``. Before pickup both ends are the pickup zone.
    """
    active = rides.filter(F.upper("ride_status").isin("ACCEPTED", "PICKED_UP") & F.col("driver_id").isNotNull()).select(
        F.col("ride_id").alias("_ride"), F.upper("ride_status").alias("ride_status"),
        F.col("pickup_zone_id").alias("start_zone"),
        F.when(F.upper("ride_status") == "ACCEPTED", F.col("pickup_zone_id")).otherwise(F.col("dropoff_zone_id")).alias("end_zone"),
    )
    joined = pings.join(active, pings.ride_id == F.col("_ride")).drop("_ride")
    side = lambda p: zones.select(F.col("zone_id").alias("_z"), F.col("latitude").cast("double").alias(f"{p}_lat"), F.col("longitude").cast("double").alias(f"{p}_lon"))
    placed = lookup_join(lookup_join(joined, side("_a"), "start_zone", "_z"), side("_b"), "end_zone", "_z")
    at = lambda axis: F.col(f"_a_{axis}") + (F.col(f"_b_{axis}") - F.col(f"_a_{axis}")) * F.col("progress")
    return placed.filter("_a_lat IS NOT NULL AND _b_lat IS NOT NULL").select(
        *pings.columns,
        F.when(F.col("ride_status") == "ACCEPTED", "PICKUP_EN_ROUTE").otherwise("TRIP_IN_PROGRESS").alias("status_context"),
        F.when(F.col("progress") >= 0.5, F.col("end_zone")).otherwise(F.col("start_zone")).alias("zone_id"),
        round_to(at("lat"), 7).alias("latitude"),
        round_to(at("lon"), 7).alias("longitude"),
    )


def not_terminal(rides: DataFrame) -> DataFrame:
    return rides.filter(~F.upper("ride_status").isin(TERMINAL_STATUSES))


def open_ride_backlog(rides: DataFrame, now: Column, days: int = LOOKBACK_DAYS) -> DataFrame:
    return not_terminal(rides).filter(F.col("requested_at") >= now - F.make_dt_interval(days=F.lit(days)))


def free_drivers(drivers: DataFrame, open_rides: DataFrame) -> DataFrame:
    """Active drivers without an open ride."""
    busy = open_rides.filter("driver_id IS NOT NULL").select("driver_id").distinct()
    return drivers.filter(F.upper("status") == "ACTIVE").join(busy, "driver_id", "left_anti")


def max_ride_sequence(rides: DataFrame) -> DataFrame:
    """Highest sequence number among well-formed ride codes, 0 when there is none. Well-formed are the six digits of the
    generator and of the checking SQL; codes with longer numbers are left out on purpose."""
    number = F.when(F.col("ride_code").rlike(RIDE_CODE_PATTERN), F.regexp_extract("ride_code", RIDE_CODE_PATTERN, 2)).try_cast("long")
    return rides.agg(F.coalesce(F.max(number), F.lit(0).cast("long")).alias("max_sequence"))


def max_ride_sequence_any_length(rides: DataFrame) -> DataFrame:
    """The same over codes of six and more digits."""
    number = F.when(F.col("ride_code").rlike(LONG_CODE_PATTERN), F.substring("ride_code", CODE_HEAD + 1, 30)).try_cast("long")
    return rides.agg(F.coalesce(F.max(number), F.lit(0).cast("long")).alias("max_sequence"))


def code_after(code: Column, step: Column) -> Column:
    """The code whose number is ``step`` greater, of six digits or as many as it takes; NULL for codes of another form."""
    number = (F.substring(code, CODE_HEAD + 1, 30).try_cast("long") + step).cast("string")
    padded = F.when(F.length(number) < 6, F.lpad(number, 6, "0")).otherwise(number)
    return F.when(code.rlike(LONG_CODE_PATTERN), F.concat(F.substring(code, 1, CODE_HEAD), padded))


def code_exists(candidates: DataFrame, rides: DataFrame, code: str = "ride_code") -> DataFrame:
    """Candidate codes with whether they are taken."""
    taken = rides.select(F.col(code).alias("_code")).distinct().withColumn("_hit", F.lit(True))
    return candidates.join(taken, F.col(code) == F.col("_code"), "left").select(*candidates.columns, F.col("_hit").isNotNull().alias("taken"))


def trip_counter(people: DataFrame, rides: DataFrame, key: str) -> DataFrame:
    """Completed trips per person against the stored counter."""
    done = rides.filter((F.upper("ride_status") == "COMPLETED") & F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return people.select(key, F.coalesce(F.col("total_trips"), F.lit(0).cast("long")).alias("stored_trips")).join(done, key, "left").select(
        key, "stored_trips", F.coalesce("_n", F.lit(0)).alias("completed_trips"),
        (F.coalesce("_n", F.lit(0)) - F.col("stored_trips")).alias("difference"),
    )
