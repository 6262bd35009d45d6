"""Facts at ride and event grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import calendar, domain, jsonpath
from fleetmart.functions.keys import surrogate_key
from fleetmart.operators.ingest import incremental_lookback
from fleetmart.operators.joins import lookup_join
from fleetmart.operators.shred import Member, shred

LOOKBACK_DAYS = 3

FARE_COLUMNS = ["base_fare", "distance_fare", "time_fare", "promo_discount", "total_fare"]


def derive_rides(rides: DataFrame) -> DataFrame:
    """Defaults, durations, flags, time bucket and upper-case status on raw rides."""
    ts = {c: F.col(c) for c in ("requested_at", "accepted_at", "picked_up_at", "completed_at")}
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(rides.schema[c].dataType)) for c in FARE_COLUMNS + ["distance_km", "duration_minutes"]}
    multiplier = F.coalesce(F.col("surge_multiplier"), F.lit(1).cast(rides.schema["surge_multiplier"].dataType))
    return rides.withColumns(
        {
            **zero,
            "surge_multiplier": multiplier,
            "requested_date": F.to_date("requested_at"),
            "acceptance_duration_secs": calendar.seconds_between(ts["requested_at"], ts["accepted_at"]),
            "pickup_wait_secs": calendar.seconds_between(ts["accepted_at"], ts["picked_up_at"]),
            "trip_duration_secs": calendar.seconds_between(ts["picked_up_at"], ts["completed_at"]),
            "is_surge": multiplier > 1,
            "has_promo": zero["promo_discount"] > 0,
            "time_bucket": domain.time_bucket(ts["requested_at"]),
            "ride_status": F.upper("ride_status"),
            "is_same_zone_trip": F.coalesce(F.col("pickup_zone_id") == F.col("dropoff_zone_id"), F.lit(False)),
        }
    )


def _zone_role(zones: DataFrame, role: str, with_key: bool) -> DataFrame:
    keep = [F.col("zone_id").alias("_zone_id"), F.col("zone_code").alias(f"{role}_zone_code"), F.col("zone_name").alias(f"{role}_zone_name")]
    keep += [F.col(c).alias(f"{role}_{c}") for c in ("city", "province", "area_type")]
    return zones.select(*keep, *(["zone_key"] if with_key else []))


def enrich_rides(rides: DataFrame, drivers: DataFrame, passengers: DataFrame, zones: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """Rides left-joined to drivers, passengers, zones in two roles and vehicle types."""
    d = drivers.select(
        F.col("driver_id").alias("_driver_id"), "driver_key", "driver_name", "vehicle_type_code", "vehicle_type_name",
        F.col("experience_tier").alias("driver_tier"),
    )
    p = passengers.select(
        F.col("passenger_id").alias("_passenger_id"), "passenger_key", "passenger_name",
        F.col("loyalty_tier").alias("passenger_tier"), F.col("age_bucket").alias("passenger_age_bucket"),
        F.col("gender").alias("passenger_gender"),
    )
    v = vehicle_types.select(
        F.col("vehicle_type_id").alias("_type_id"), "vehicle_type_key", "vehicle_category", "fare_tier",
        F.col("capacity").alias("vehicle_capacity"),
    )
    out = lookup_join(rides, _zone_role(zones, "pickup", True), "pickup_zone_id", "_zone_id", "ride_id")
    out = lookup_join(out, _zone_role(zones, "dropoff", False), "dropoff_zone_id", "_zone_id", "ride_id")
    out = lookup_join(out, v, "vehicle_type_id", "_type_id", "ride_id")
    out = lookup_join(out, d, "driver_id", "_driver_id", "ride_id")
    return lookup_join(out, p, "passenger_id", "_passenger_id", "ride_id")


FCT_RIDES_COLUMNS = [
    "ride_key", "driver_key", "passenger_key", "zone_key", "vehicle_type_key",
    "ride_id", "ride_code",
    "driver_id", "passenger_id", "vehicle_type_id", "pickup_zone_id", "dropoff_zone_id", "requested_date",
    "ride_status", "time_bucket", "is_surge", "has_promo",
    "driver_name", "vehicle_type_code", "vehicle_type_name", "driver_tier",
    "passenger_name", "passenger_tier", "passenger_age_bucket", "passenger_gender",
    "pickup_zone_code", "pickup_zone_name", "pickup_city", "pickup_province", "pickup_area_type",
    "dropoff_zone_code", "dropoff_zone_name", "dropoff_city", "dropoff_province", "dropoff_area_type",
    "is_same_zone_trip",
    "vehicle_category", "fare_tier", "vehicle_capacity",
    "requested_at", "accepted_at", "picked_up_at", "completed_at", "cancelled_at",
    "acceptance_duration_secs", "pickup_wait_secs", "trip_duration_secs", "distance_km", "duration_minutes",
    "base_fare", "distance_fare", "time_fare", "surge_multiplier", "promo_discount", "total_fare",
    "passenger_rating", "driver_rating",
    "cancellation_reason",
    "updated_at",
]


def fct_rides(
    rides: DataFrame,
    drivers: DataFrame,
    passengers: DataFrame,
    zones: DataFrame,
    vehicle_types: DataFrame,
    now: Column | None = None,
    lookback_days: int | None = None,
) -> DataFrame:
    """One row per ride. With ``lookback_days`` only rides updated within that many days before ``now`` are rebuilt."""
    source = rides if lookback_days is None else incremental_lookback(rides, "updated_at", now, lookback_days)
    enriched = enrich_rides(derive_rides(source), drivers, passengers, zones, vehicle_types)
    return enriched.withColumn("ride_key", surrogate_key(F.col("ride_id"))).select(*FCT_RIDES_COLUMNS)


# Payload keys per output field. The first is the contract's key, the second the one writers also use.
PAYLOAD_FIELDS = [
    ("req_surge", ("surge", "surge_multiplier"), "double"),
    ("req_zone", ("zone", "pickup_zone"), "string"),
    ("acc_driver_id", ("driver_id",), "string"),
    ("cmp_fare", ("fare", "total_fare"), "double"),
    ("cmp_distance_km", ("distance", "estimated_distance_km"), "double"),
    ("can_reason", ("reason", "cancellation_reason"), "string"),
]


def parse_event_payload(events: DataFrame, both_key_sets: bool = True) -> DataFrame:
    """Typed payload fields. The document is parsed once per row for all keys."""
    used = [(name, keys if both_key_sets else keys[:1], kind) for name, keys, kind in PAYLOAD_FIELDS]
    keys = [k for _, group, _ in used for k in group]
    raw = events.select("*", F.json_tuple("event_payload", *keys).alias(*[f"_j_{k}" for k in keys]))
    fields = {}
    for name, group, kind in used:
        scalars = [jsonpath.scalar_only(F.col(f"_j_{k}"), F.col("event_payload"), k) for k in group]
        fields[name] = F.coalesce(*scalars).try_cast(kind)
    return raw.withColumns(fields).drop(*[f"_j_{k}" for k in keys])


def parse_event_payload_variant(events: DataFrame, both_key_sets: bool = True) -> DataFrame:
    """The same fields with ``payload_rest``: JSON of all members they do not take, or a text that is no JSON object.

    Numbers in text fields come in their shortest form, and a document that repeats a key cannot be read.
    """
    used = [(name, keys if both_key_sets else keys[:1], kind) for name, keys, kind in PAYLOAD_FIELDS]
    wanted = [Member(key, f"_v_{key}", kind) for _, keys, kind in used for key in keys]
    rows = shred(events, "event_payload", wanted, "payload_rest")
    return rows.withColumns({name: F.coalesce(*[F.col(f"_v_{k}") for k in keys]) for name, keys, _ in used}).drop(*[m.column for m in wanted])


def ride_context(rides: DataFrame) -> DataFrame:
    """What events take from a ride, straight from the raw rides: no dimension is joined for it."""
    return derive_rides(rides).withColumn("ride_key", surrogate_key(F.col("ride_id"))).select(
        "ride_id", "ride_key", "ride_status", "vehicle_type_id", "pickup_zone_id", "driver_id", "passenger_id", "total_fare", "requested_date"
    )


def enrich_events(events: DataFrame, rides: DataFrame) -> DataFrame:
    """Events left-joined to the context columns of the ride fact or of ``ride_context``; a hot ride is split by AQE."""
    context = rides.select(
        F.col("ride_id").alias("_ride_id"), "ride_key", "ride_status", "vehicle_type_id", "pickup_zone_id", "driver_id",
        "passenger_id", "total_fare", "requested_date",
    )
    return lookup_join(events, context, "ride_id", "_ride_id", "event_id")


def fct_ride_events(
    events: DataFrame, rides: DataFrame, now: Column | None = None, lookback_days: int | None = None, both_key_sets: bool = True
) -> DataFrame:
    source = events if lookback_days is None else incremental_lookback(events, "occurred_at", now, lookback_days)
    joined = enrich_events(parse_event_payload(source, both_key_sets), rides)
    return joined.select(
        surrogate_key(F.col("event_id")).alias("event_key"),
        "ride_key",
        "event_id",
        "ride_id",
        "event_type",
        "occurred_at",
        F.to_date("occurred_at").alias("occurred_date"),
        *[name for name, _, _ in PAYLOAD_FIELDS],
        "ride_status",
        "vehicle_type_id",
        "pickup_zone_id",
        "driver_id",
        "passenger_id",
        "total_fare",
        "requested_date",
    )


def parse_gateway_response(payments: DataFrame, column: str = "gateway_raw_response") -> DataFrame:
    """Payments with the seven gateway fields added."""
    return payments.select("*", *jsonpath.gateway_columns(F.col(column)))
