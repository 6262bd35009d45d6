"""Calendar rules where Spark's default differs from the warehouse's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start_sunday(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_number_sunday(day: Column) -> Column:
    """Week 0..53 counted from the first Sunday of the year."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def calendar_year_iso_week(day: Column) -> Column:
    """Calendar year with the ISO week number, as the label is defined (they disagree around New Year)."""
    return F.concat(F.year(day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def years_between_boundaries(later: Column, earlier: Column) -> Column:
    """Year boundaries crossed, not elapsed years."""
    return F.year(later) - F.year(earlier)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds from start to end, truncated; NULL when either is missing."""
    return F.timestamp_diff("SECOND", start, end)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def date_key(day: Column) -> Column:
    """yyyymmdd as a long."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("long")


def recency_bucket(day: Column, today: Column, future_first: bool = True) -> Column:
    """Age class of a day. ``future_first=False`` keeps the rule under which future days count as ``last_7d``."""
    age = F.datediff(today, day)
    past = (
        F.when(age <= 7, "last_7d").when(age <= 30, "last_30d").when(age <= 90, "last_90d").otherwise("older")
    )
    return F.when(age < 0, "future").otherwise(past) if future_first else past
