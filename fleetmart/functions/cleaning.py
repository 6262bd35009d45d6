"""Cleaning of contact, identity and plate fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted lengths and patterns of the cleaned fields.
PHONE_MIN_DIGITS = 10
PHONE_MAX_DIGITS = 13
NATIONAL_ID_DIGITS = 16
EMAIL_PATTERN = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"
CANONICAL_PHONE_PATTERN = r"^08[0-9]{8,11}$"


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def clean_phone(value: Column) -> Column:
    """National form with a leading 0; NULL for other prefixes and wrong lengths."""
    digits = digits_only(value)
    national = F.when(digits.startswith("62"), F.concat(F.lit("0"), digits.substr(F.lit(3), F.length(digits)))).when(
        digits.startswith("0"), digits
    )
    return F.when(F.length(national).between(PHONE_MIN_DIGITS, PHONE_MAX_DIGITS), national)


def clean_national_id(value: Column) -> Column:
    digits = digits_only(value)
    return F.when(F.length(digits) == NATIONAL_ID_DIGITS, digits)


def clean_plate(value: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(value, r"\s+", " ")))


def is_valid_email(value: Column) -> Column:
    return F.lower(F.trim(value)).rlike(EMAIL_PATTERN)


def is_canonical_phone(value: Column) -> Column:
    return value.rlike(CANONICAL_PHONE_PATTERN)


def phone_was_dirty(value: Column) -> Column:
    return F.coalesce(value.startswith("+62") | value.contains("-"), F.lit(False))


def national_id_was_dirty(value: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(value, r"\s", "")) != NATIONAL_ID_DIGITS, F.lit(False))


def plate_was_dirty(value: Column) -> Column:
    return F.coalesce(F.lower(value) == value, F.lit(False))


def clamp(value: Column, low: float, high: float, default: float) -> Column:
    """Keep a decimal within [low, high]; NULL becomes the default."""
    filled = F.coalesce(value, F.lit(default).cast("decimal(5,2)"))
    return F.greatest(
        F.lit(low).cast("decimal(5,2)"), F.least(F.lit(high).cast("decimal(5,2)"), filled.cast("decimal(5,2)"))
    )
