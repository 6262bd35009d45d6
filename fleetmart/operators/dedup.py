"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """The row with the greatest ``order_cols`` per key.

    Ties are settled by ``tie_break`` (all other columns by default), so the result does not depend on row order. The
    rank filter is evaluated before the shuffle as well: each task sends one row per key, also for a key that holds most
    of the table.
    """
    if tie_break is None:
        tie_break = [
            f.name for f in df.schema if f.name not in (*keys, *order_cols) and not isinstance(f.dataType, _UNORDERED)
        ]
    order = [F.col(c).desc_nulls_last() for c in (*order_cols, *tie_break)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")


def top_per_group(counts: DataFrame, group: list[str], value: str, weight: str) -> DataFrame:
    """The heaviest value per group over pre-counted rows; equal weights go to the smallest value, NULL can win."""
    ranked = counts.withColumn(
        "_rn",
        F.row_number().over(Window.partitionBy(*group).orderBy(F.col(weight).desc(), F.col(value).asc_nulls_last())),
    )
    return ranked.filter("_rn = 1").drop("_rn", weight)
