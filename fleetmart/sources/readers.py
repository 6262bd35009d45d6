"""Readers for relational tables, documents, warehouse tables, change topics, landing folders and seed files.

Drivers for PostgreSQL, MySQL, MongoDB and Kafka are cluster packages; the functions only set options, so the same call
works once the package is on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.sinks import path_exists
from fleetmart.sources.contracts import TableSpec

# Fixed value: the change topics that are landed.
TOPIC_PATTERN = r"cdc\.(public\.(drivers|passengers|rides|vehicle_types|zones)|ride_ops_mg\.(ride_events|driver_location_stream))"


def scan_relational(
    spark: SparkSession, url: str, table: str, split_column: str | None = None, lower: str | int | None = None,
    upper: str | int | None = None, partitions: int = 1, properties: dict[str, str] | None = None,
) -> DataFrame:
    """A relational table, read in parallel ranges of ``split_column`` when given. Filters and columns are pushed down."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if split_column:
        reader = reader.options(partitionColumn=split_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return reader.load()


def scan_documents(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", unreadable: str | None = None) -> DataFrame:
    """Exported documents with a declared nested schema; the payload stays nested.

    ``unreadable`` names a further column with the text of documents that cannot be read, NULL for the others.
    """
    if unreadable is None:
        return spark.read.schema(schema).format(fmt).load(path)
    told = T.StructType([*schema.fields, T.StructField(unreadable, T.StringType())])
    return spark.read.schema(told).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", unreadable).format(fmt).load(path)


def scan_warehouse(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_topic(spark: SparkSession, servers: str, pattern: str = TOPIC_PATTERN, max_offsets: int | None = None) -> DataFrame:
    """Change topics chosen by a pattern, as a stream."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribePattern", pattern)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.option("startingOffsets", "earliest").load()


def scan_topic_files(spark: SparkSession, root: str, schema: T.StructType, pattern: str = TOPIC_PATTERN, max_files: int | None = None) -> DataFrame:
    """The same from files laid out as ``topic=<name>/``; topics are chosen by the same pattern."""
    reader = spark.readStream.schema(schema.add("topic", T.StringType())).option("basePath", root)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root).filter(F.col("topic").rlike(f"^{pattern}$"))


def scan_landing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All files below a topic prefix with merged schemas; None when there is nothing to load."""
    if not path_exists(spark, path):
        return None
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def scan_federated(extract: DataFrame, warehouse: DataFrame, key: str) -> DataFrame:
    """Extract rows marked with whether the warehouse already holds their key: two sources in one plan."""
    known = warehouse.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return extract.join(known, F.col(key) == F.col("_k"), "left").select(*extract.columns, F.col("_hit").isNotNull().alias("already_loaded"))


def scan_seed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def scan_declared(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return spark.read.schema(spec.schema()).parquet(path)
