"""Mergeable sketches: kept per day, combined to any longer period without a look at the rows.

The distinct sketch is a HyperLogLog; its standard error is about 1.04 / sqrt(2^lg). The frequent-items sketch holds a
bounded number of counters per group; while a group has no more different values than counters all counts are exact,
and beyond that a count is right to within 3.5 times the rows divided by the counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 14
COUNTERS = 1024


def distinct_error(lg: int = LG_BUCKETS, sigmas: float = 3.0) -> float:
    """Relative error that a distinct estimate exceeds only beyond so many standard errors."""
    return sigmas * 1.04 / 2 ** (lg / 2)


def distinct_sketch(df: DataFrame, group: list[str | Column], column: str, lg: int = LG_BUCKETS) -> DataFrame:
    """One sketch of the different values per group; NULLs do not count."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(lg)).alias("sketch"))


def union_distinct(sketches: DataFrame, group: list[str | Column]) -> DataFrame:
    """Sketches of wider groups from those of narrower ones, with their estimate."""
    wide = sketches.groupBy(*group).agg(F.hll_union_agg("sketch").alias("sketch"))
    return wide.withColumn("estimate", F.hll_sketch_estimate("sketch"))


def top_sketch(df: DataFrame, group: list[str | Column], column: str, counters: int = COUNTERS) -> DataFrame:
    """One sketch of the frequent values per group, with its rows; NULLs do not count."""
    return df.where(F.col(column).isNotNull()).groupBy(*group).agg(F.expr(f"approx_top_k_accumulate(`{column}`, {int(counters)})").alias("sketch"), F.count(column).alias("rows"))


def union_top(sketches: DataFrame, group: list[str | Column], counters: int = COUNTERS) -> DataFrame:
    """Sketches of wider groups from those of narrower ones."""
    return sketches.groupBy(*group).agg(F.expr(f"approx_top_k_combine(sketch, {int(counters)})").alias("sketch"), F.sum("rows").alias("rows"))


def top_values(sketches: DataFrame, k: int, counters: int = COUNTERS) -> DataFrame:
    """The k most frequent values per sketch: ``top`` (item, count), by falling count, and ``bound``, how far a count may be off."""
    return sketches.withColumns({"top": F.expr(f"approx_top_k_estimate(sketch, {int(k)})"), "bound": F.ceil(F.col("rows") * 3.5 / counters)}).drop("sketch")


def clear_winner(tops: DataFrame, name: str) -> DataFrame:
    """The most frequent value where its lead over the second is beyond the bound of both, else NULL; needs two values in ``top``."""
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    sure = F.coalesce(first["count"], F.lit(0)) - F.coalesce(second["count"], F.lit(0)) > 2 * F.col("bound")
    return tops.withColumn(name, F.when(sure, first["item"])).drop("top")
