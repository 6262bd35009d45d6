"""Dimensions: zones, vehicle types, drivers, passengers, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import calendar, cleaning, domain
from fleetmart.functions.keys import surrogate_key, utc_text
from fleetmart.operators.history import scd2_current, scd2_versions
from fleetmart.operators.joins import lookup_join


def dim_zones(zones: DataFrame) -> DataFrame:
    """Active zones with province and area class."""
    return zones.filter("is_active").select(
        surrogate_key(F.col("zone_id")).alias("zone_key"),
        "zone_id",
        "zone_code",
        "zone_name",
        "city",
        "latitude",
        "longitude",
        "is_active",
        domain.province(F.col("city")).alias("province"),
        domain.area_type(F.col("zone_code")).alias("area_type"),
        "created_at",
    )


def dim_vehicle_types(vehicle_types: DataFrame) -> DataFrame:
    return vehicle_types.select(
        surrogate_key(F.col("vehicle_type_id")).alias("vehicle_type_key"),
        "vehicle_type_id",
        "type_code",
        "type_name",
        "base_fare",
        "per_km_rate",
        "per_minute_rate",
        "capacity",
        domain.vehicle_category(F.col("type_code")).alias("vehicle_category"),
        domain.fare_tier(F.col("base_fare")).alias("fare_tier"),
        "created_at",
    )


def clean_drivers(drivers: DataFrame) -> DataFrame:
    """Cleaned contact fields, clamped rating, defaults and dirty flags; other columns pass through."""
    phone, nik, plate = F.col("phone_number"), F.col("nik"), F.col("license_plate")
    return drivers.select(
        *[c for c in drivers.columns if c not in ("phone_number", "nik", "license_plate", "rating", "total_trips", "status")],
        cleaning.clean_phone(phone).alias("phone_number"),
        cleaning.clean_national_id(nik).alias("nik"),
        cleaning.clean_plate(plate).alias("license_plate"),
        cleaning.clamp(F.col("rating"), 1.0, 5.0, 5.0).alias("rating"),
        F.coalesce(F.col("total_trips"), F.lit(0).cast("long")).alias("total_trips"),
        F.upper("status").alias("driver_status"),
        cleaning.phone_was_dirty(phone).alias("phone_was_dirty"),
        cleaning.national_id_was_dirty(nik).alias("nik_was_dirty"),
        cleaning.plate_was_dirty(plate).alias("plate_was_dirty"),
    )


def clean_passengers(passengers: DataFrame, today: Column) -> DataFrame:
    phone = F.col("phone_number")
    age = calendar.years_between_boundaries(today, F.col("birth_date"))
    return passengers.select(
        *[c for c in passengers.columns if c not in ("phone_number", "gender", "total_trips", "status")],
        cleaning.clean_phone(phone).alias("phone_number"),
        age.alias("age_years"),
        domain.age_bucket(age).alias("age_bucket"),
        F.upper(F.coalesce("gender", F.lit("UNKNOWN"))).alias("gender"),
        F.coalesce(F.col("total_trips"), F.lit(0).cast("long")).alias("total_trips"),
        F.upper("status").alias("passenger_status"),
        cleaning.phone_was_dirty(phone).alias("phone_was_dirty"),
    )


def _home_zone(zones: DataFrame, *extra: str) -> DataFrame:
    names = {"zone_code": "home_zone_code", "zone_name": "home_zone_name", "city": "home_city", "province": "home_province"}
    names.update({c: f"home_{c}" for c in extra})
    return zones.select(F.col("zone_id").alias("_zone_id"), *[F.col(k).alias(v) for k, v in names.items()])


def dim_drivers(history: DataFrame, vehicle_types: DataFrame, zones: DataFrame, all_versions: bool = False) -> DataFrame:
    """Current driver versions, cleaned, with registered vehicle type, tier and home zone.

    ``history`` is the driver snapshot; ``vehicle_types`` and ``zones`` are the built dimensions. Only open versions are
    kept, so a driver id appears once and joins on it do not fan out; ``all_versions`` keeps the closed ones too.
    """
    types = vehicle_types.select(
        F.col("vehicle_type_id").alias("_type_id"),
        F.col("vehicle_type_id").alias("matched_type_id"),
        F.col("type_code").alias("vehicle_type_code"),
        F.col("type_name").alias("vehicle_type_name"),
        F.col("capacity").alias("vehicle_capacity"),
        "vehicle_category",
    )
    cleaned = clean_drivers((scd2_versions if all_versions else scd2_current)(history))
    joined = lookup_join(cleaned, types, "vehicle_type_id", "_type_id", spread_by="driver_id")
    joined = lookup_join(joined, _home_zone(zones, "area_type"), "home_zone_id", "_zone_id", spread_by="driver_id")
    return joined.select(
        surrogate_key(F.col("driver_id"), utc_text(F.col("valid_from"))).alias("driver_key"),
        "driver_id",
        "driver_code",
        F.col("full_name").alias("driver_name"),
        "phone_number",
        "email",
        "nik",
        "sim_number",
        "license_plate",
        "driver_status",
        "rating",
        "total_trips",
        "joined_at",
        "updated_at",
        "phone_was_dirty",
        "nik_was_dirty",
        "plate_was_dirty",
        F.col("matched_type_id").alias("vehicle_type_id"),
        "vehicle_type_code",
        "vehicle_type_name",
        "vehicle_capacity",
        "vehicle_category",
        "vehicle_brand",
        "vehicle_model",
        "vehicle_year",
        "vehicle_color",
        domain.experience_tier(F.col("total_trips")).alias("experience_tier"),
        "home_zone_code",
        "home_zone_name",
        "home_city",
        "home_province",
        "home_area_type",
        "valid_from",
        "valid_to",
        "is_current",
    )


def dim_passengers(history: DataFrame, zones: DataFrame, today: Column, all_versions: bool = False) -> DataFrame:
    cleaned = clean_passengers((scd2_versions if all_versions else scd2_current)(history), today)
    joined = lookup_join(cleaned, _home_zone(zones), "home_zone_id", "_zone_id", spread_by="passenger_id")
    return joined.select(
        surrogate_key(F.col("passenger_id"), utc_text(F.col("valid_from"))).alias("passenger_key"),
        "passenger_id",
        "passenger_code",
        F.col("full_name").alias("passenger_name"),
        "phone_number",
        "email",
        "birth_date",
        "age_years",
        "age_bucket",
        "gender",
        "referral_code",
        "is_verified",
        "total_trips",
        "passenger_status",
        "registered_at",
        "updated_at",
        "phone_was_dirty",
        domain.loyalty_tier(F.col("total_trips")).alias("loyalty_tier"),
        "home_zone_code",
        "home_zone_name",
        "home_city",
        "home_province",
        "valid_from",
        "valid_to",
        "is_current",
    )


def date_spine(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``; both evaluated on the one-row ``bounds``."""
    return bounds.select(F.explode(F.sequence(start, F.date_sub(end, 1))).alias("date_day"))


def dim_date(spine: DataFrame, today: Column, holidays: DataFrame | None = None, future_first: bool = True) -> DataFrame:
    """Calendar attributes per day. ``holidays(holiday_date)`` marks public holidays; without it none is marked."""
    day = F.col("date_day")
    weekend = F.dayofweek(day).isin(1, 7)
    if holidays is None:
        days = spine.withColumn("is_public_holiday", F.lit(False))
    else:
        marks = holidays.select(F.col("holiday_date").alias("_day")).distinct().withColumn("_hit", F.lit(True))
        days = (
            spine.join(marks, spine.date_day == marks._day, "left")
            .withColumn("is_public_holiday", F.col("_hit").isNotNull())
            .drop("_day", "_hit")
        )
    return days.select(
        surrogate_key(day).alias("date_key"),
        day.alias("date_id"),
        day.alias("full_date"),
        F.year(day).alias("year_num"),
        F.month(day).alias("month_num"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week_num"),
        F.dayofyear(day).alias("day_of_year"),
        calendar.week_number_sunday(day).alias("week_of_year"),
        F.quarter(day).alias("quarter_num"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyyMM").alias("year_month"),
        calendar.year_quarter(day).alias("year_quarter"),
        calendar.calendar_year_iso_week(day).alias("iso_year_week"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        "is_public_holiday",
        F.datediff(today, day).alias("days_ago"),
        calendar.recency_bucket(day, today, future_first).alias("recency_bucket"),
    )
