"""Rounding, ratios and averages that give the same digits on every run.

Sums stay in decimal (exact, independent of row order); one division is done in double; rounding goes through a
decimal, so a half is decided by the decimal digits and not by the binary form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUND_TYPE = "decimal(28,8)"


def round_to(value: Column, places: int = 0) -> Column:
    return F.round(value.cast(ROUND_TYPE), places).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double, NULL on a zero or NULL divisor."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return round_to(ratio(part, whole) * F.lit(100.0), places)


def mean(value: Column) -> Column:
    """Average of a decimal or integer column: exact sum over the number of non-NULL values."""
    return ratio(F.sum(value), F.count(value))
