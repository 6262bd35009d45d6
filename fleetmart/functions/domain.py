"""Business classes: tiers, buckets, categories, regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class limits and labels.
DRIVER_TIERS = [(1000, "Platinum"), (500, "Gold"), (100, "Silver")]
DRIVER_TIER_ELSE = "Bronze"
PASSENGER_TIERS = [(200, "Platinum"), (50, "Gold"), (10, "Silver")]
PASSENGER_TIER_ELSE = "New"
AGE_BUCKETS = [(18, 25), (26, 35), (36, 45), (46, 55)]
AGE_BUCKET_ELSE = "56+"
TIME_BUCKETS = [("morning_peak", [(7, 9)]), ("evening_peak", [(17, 19)]), ("late_night", [(22, 23), (0, 4)])]
TIME_BUCKET_ELSE = "off_peak"
VEHICLE_CATEGORIES = {
    "MOTOR": "2-Wheeler",
    "ECONOMI": "Standard Car",
    "COMFORT": "Standard Car",
    "SUV": "Large Car",
    "PREMIUM": "Premium Car",
}
FARE_TIERS = [(10000, "Economy"), (20000, "Mid-Range")]
FARE_TIER_ELSE = "Premium"
PROVINCES = {"Jakarta": "DKI Jakarta", "Banten": "Banten", "Jawa Barat": "Jawa Barat"}
PROVINCE_ELSE = "Other"
CORE_ZONE_PREFIX = "JKT-"
RIDE_STATUSES = ["REQUESTED", "ACCEPTED", "PICKED_UP", "COMPLETED", "CANCELLED", "NO_DRIVER"]
TERMINAL_STATUSES = ["COMPLETED", "CANCELLED", "NO_DRIVER"]
ALLOWED_TRANSITIONS = [
    ("REQUESTED", "ACCEPTED"),
    ("REQUESTED", "NO_DRIVER"),
    ("ACCEPTED", "PICKED_UP"),
    ("ACCEPTED", "CANCELLED"),
    ("PICKED_UP", "COMPLETED"),
]
EVENT_TYPES = ["RIDE_REQUESTED", "RIDE_ACCEPTED", "PASSENGER_PICKED_UP", "RIDE_COMPLETED", "RIDE_CANCELLED"]


def _at_least(value: Column, limits: list[tuple[int, str]], otherwise: str) -> Column:
    expr = F
    for limit, label in limits:
        expr = expr.when(value >= limit, label)
    return expr.otherwise(otherwise)


def experience_tier(trips: Column) -> Column:
    return _at_least(trips, DRIVER_TIERS, DRIVER_TIER_ELSE)


def loyalty_tier(trips: Column) -> Column:
    return _at_least(trips, PASSENGER_TIERS, PASSENGER_TIER_ELSE)


def age_bucket(age: Column) -> Column:
    """Under-18 and unknown ages fall into the last class, as the dimension defines it."""
    expr = F
    for low, high in AGE_BUCKETS:
        expr = expr.when(age.between(low, high), f"{low}-{high}")
    return expr.otherwise(AGE_BUCKET_ELSE)


def time_bucket(ts: Column) -> Column:
    hour = F.hour(ts)
    expr = F
    for label, spans in TIME_BUCKETS:
        inside = F.lit(False)
        for low, high in spans:
            inside = inside | hour.between(low, high)
        expr = expr.when(inside, label)
    return expr.otherwise(TIME_BUCKET_ELSE)


def vehicle_category(code: Column) -> Column:
    expr = F
    for known, label in VEHICLE_CATEGORIES.items():
        expr = expr.when(code == known, label)
    return expr


def fare_tier(base_fare: Column) -> Column:
    expr = F
    for limit, label in FARE_TIERS:
        expr = expr.when(base_fare < limit, label)
    return expr.otherwise(FARE_TIER_ELSE)


def province(city: Column) -> Column:
    expr = F
    for known, label in PROVINCES.items():
        expr = expr.when(city == known, label)
    return expr.otherwise(PROVINCE_ELSE)


def area_type(zone_code: Column) -> Column:
    return F.when(zone_code.startswith(CORE_ZONE_PREFIX), "Jakarta Core").otherwise("Greater Jakarta")
