"""Dense integer keys for natural keys: a map on disk that only grows.

Every load numbers the natural keys it sees first, by their order, behind the greatest number given so far. Numbers come
from row counts per partition, so no row passes through the driver, and a key once given never changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.joins import lookup_join
from fleetmart.operators.sinks import path_exists, remove_path

KEYS_PER_PARTITION = 1_000_000
_INDEX_BITS = 33
SCHEMA = "natural_key string, dense_key long, load int"


def _loads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished loads; a load that broke off has no success mark."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hadoop) if f.isDirectory()]
    return sorted(int(n[5:]) for n in names if n.startswith("load=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def key_map(spark: SparkSession, path: str) -> DataFrame:
    """(natural_key, dense_key, load) of all finished loads."""
    loads = _loads(spark, path)
    if not loads:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(T.StructType.fromDDL(SCHEMA)).parquet(*[f"{path}/load={n}" for n in loads])


def extend_key_map(spark: SparkSession, path: str, keys: DataFrame, column: str, keys_per_partition: int = KEYS_PER_PARTITION) -> DataFrame:
    """Numbers the natural keys not in the map yet and returns the whole map.

    New keys are written once, in ranges sorted by key; a row's number is the rows of the ranges before, plus its place.
    One row per range is added up. NULL has no key. A load that broke off leaves nothing that counts, and the next one
    takes its number. Loads into one map must follow each other.
    """
    known = key_map(spark, path)
    loads = _loads(spark, path)
    load = (loads[-1] if loads else 0) + 1
    staged, target = f"{path}/_staged", f"{path}/load={load}"
    remove_path(spark, staged)
    remove_path(spark, target)
    wanted = keys.select(F.col(column).cast("string").alias("natural_key")).where("natural_key is not null").distinct()
    fresh = wanted.join(known.select("natural_key"), "natural_key", "left_anti")
    fresh.write.parquet(f"{staged}/keys")
    fresh = spark.read.schema("natural_key string").parquet(f"{staged}/keys")
    parts = max(1, -(-fresh.count() // keys_per_partition))
    ordered = fresh.repartitionByRange(parts, "natural_key").sortWithinPartitions("natural_key")
    ordered.withColumn("place", F.monotonically_increasing_id()).write.parquet(f"{staged}/ordered")
    ordered = spark.read.schema("natural_key string, place long").parquet(f"{staged}/ordered")
    ordered = ordered.select("natural_key", F.shiftright("place", _INDEX_BITS).alias("part"), F.col("place").bitwiseAND((1 << _INDEX_BITS) - 1).alias("index"))
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    last = known.agg(F.coalesce(F.max("dense_key"), F.lit(0).cast("long"))).first()[0]
    numbered = ordered.join(before, "part").select("natural_key", (F.col("before") + F.col("index") + last + 1).alias("dense_key"), F.lit(load).alias("load"))
    numbered.write.parquet(target)
    remove_path(spark, staged)
    return key_map(spark, path)


def with_dense_key(rows: DataFrame, keys: DataFrame, column: str, name: str, spread_by: str | None = None) -> DataFrame:
    """Rows with the dense key of a natural key, NULL where the map has none."""
    named = keys.select(F.col("natural_key").alias("__natural"), F.col("dense_key").alias(name))
    texted = rows.withColumn("__text", F.col(column).cast("string"))
    return lookup_join(texted, named, "__text", "__natural", spread_by or column).drop("__text")
