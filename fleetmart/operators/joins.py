"""Joins that stay balanced: size-checked broadcast, spread NULL keys, left to AQE for hot keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of all files a plan names, whole and before any pruning: an upper bound that runs no job."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))


def broadcast_limit(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_BROADCAST_BYTES))
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)b?\s*", raw.lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def is_small(df: DataFrame) -> bool:
    """True when all a dimension reads fits the session's broadcast threshold.

    Meant for dimensions made by filters, projections and many-to-one lookups, which have no more rows than their
    largest input.
    """
    limit = broadcast_limit(df)
    return limit > 0 and scanned_bytes(df) <= limit


def common_type(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> T.DataType:
    """The type in which an equality of two columns is decided."""
    one, two = left.schema[left_key].dataType, right.schema[right_key].dataType
    if one == two:
        return one
    pair = T.StructType([T.StructField("a", one), T.StructField("b", two)])
    return left.sparkSession.createDataFrame([], pair).select(F.coalesce("a", "b").alias("k")).schema["k"].dataType


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, spread_by: str | None = None, also: Column | None = None) -> DataFrame:
    """fact LEFT JOIN dim on fact_key = dim_key, and on ``also`` if given; the dimension's key column is dropped.

    Both keys are brought to one type and compared in it, whatever the size of the dimension, so the size never changes
    the result. A dimension within the broadcast threshold is broadcast. A larger one is shuffled on the key and on its
    hash; rows without a key match nothing and take a hash of ``spread_by`` instead, so they are spread over all tasks
    and do not meet in one. AQE splits hot keys; the join is followed by another exchange or a write, so it keeps its
    skew handling.
    """
    kind = common_type(fact, fact_key, dim, dim_key)
    meets = lambda same: same if also is None else same & also
    key = lambda column: F.col(column).cast(kind)
    if is_small(dim):
        keyed = F.broadcast(dim.withColumn("_dim_key", key(dim_key)).drop(dim_key))
        return fact.withColumn("_fact_key", key(fact_key)).join(keyed, meets(F.col("_fact_key") == F.col("_dim_key")), "left").drop("_fact_key", "_dim_key")
    # A zero of either sign is one key.
    plain = lambda column: F.when(F.col(column) == 0, F.lit(0).cast(kind)).otherwise(F.col(column)) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(column)
    left = fact.withColumn("_fact_key", key(fact_key)).withColumn("_fact_key", plain("_fact_key"))
    left = left.withColumn("_fact_hash", F.when(F.col("_fact_key").isNull(), F.xxhash64(F.lit("no key"), F.col(spread_by or fact_key))).otherwise(F.xxhash64("_fact_key")))
    right = dim.withColumn("_dim_key", key(dim_key)).drop(dim_key).withColumn("_dim_key", plain("_dim_key")).withColumn("_dim_hash", F.xxhash64("_dim_key"))
    same = (F.col("_fact_key") == F.col("_dim_key")) & (F.col("_fact_hash") == F.col("_dim_hash"))
    return left.join(right, meets(same), "left").drop("_fact_key", "_dim_key", "_fact_hash", "_dim_hash")
