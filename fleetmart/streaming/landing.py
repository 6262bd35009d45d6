"""Change streams into files: unwrap, land by wall clock, roll files, dead letters, hourly loads, late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetmart.operators.changes import cdc_unwrap

# Landing zone time, file size and roll interval, folder layout, lateness limit.
LANDING_TZ = "Asia/Jakarta"
RECORDS_PER_FILE = 1000
ROLL_INTERVAL = "10 minutes"
LANDING_LAYOUT = ["topic", "year", "month", "day", "hour"]
LATE_LIMIT = "3 days"
CORRUPT = "_corrupt_record"


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Envelope files as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_unwrap_changes(envelopes: DataFrame, drop_tombstones: bool = False) -> DataFrame:
    return cdc_unwrap(envelopes, drop_tombstones)


def landing_columns(clock: Column | None = None, tz: str = LANDING_TZ) -> dict[str, Column]:
    """Wall-clock folder values in the landing zone's local time."""
    local = F.from_utc_timestamp(F.current_timestamp() if clock is None else clock, tz)
    return {name: F.date_format(local, form) for name, form in zip(LANDING_LAYOUT[1:], ["yyyy", "MM", "dd", "HH"])}


def stream_land(
    rows: DataFrame, path: str, checkpoint: str, topic: str | Column, tz: str = LANDING_TZ, clock: Column | None = None,
    records_per_file: int = RECORDS_PER_FILE, interval: str | None = None,
) -> StreamingQuery:
    """Append to ``topic=/year=/month=/day=/hour=`` Parquet folders, Snappy, at most ``records_per_file`` rows a file.

    With ``interval`` files roll on that schedule; without it everything available is landed and the query ends.
    """
    name = F.lit(topic) if isinstance(topic, str) else topic
    writer = (
        rows.withColumns({"topic": name, **landing_columns(clock, tz)})
        .writeStream.format("parquet")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", records_per_file)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*LANDING_LAYOUT)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path)


def parse_records(text: DataFrame, schema: T.StructType, column: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """Parsed record in ``record`` and the raw text in ``_corrupt_record`` when it does not convert."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    parsed = text.withColumn("_p", F.from_json(F.col(column), full if mode == "PERMISSIVE" else schema, options))
    if mode != "PERMISSIVE":
        return parsed.select(F.struct("_p.*").alias("record"), F.lit(None).cast("string").alias(CORRUPT))
    return parsed.select(F.struct(*[F.col(f"_p.{f.name}") for f in schema.fields]).alias("record"), F.col(f"_p.{CORRUPT}").alias(CORRUPT))


def stream_dlq(
    text: DataFrame, schema: T.StructType, good_path: str, dlq_path: str, checkpoint: str, tolerance: str = "all", source: str = "stream"
) -> StreamingQuery:
    """Good records to one table, unreadable ones with their context to another; the stream goes on.

    ``tolerance='none'`` fails on the first unreadable record. Each micro-batch owns a folder it overwrites, so a batch
    that is run again does not double its rows.
    """
    strict = tolerance == "none"
    parsed = parse_records(text, schema, mode="FAILFAST" if strict else "PERMISSIVE")

    def write(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter(F.col(CORRUPT).isNull()).select("record.*")
        good.write.mode("overwrite").parquet(f"{good_path}/batch_id={batch_id}")
        if not strict:
            bad = batch.filter(F.col(CORRUPT).isNotNull()).select(
                F.col(CORRUPT).alias("raw"), F.lit(source).alias("source"), F.current_timestamp().alias("failed_at")
            )
            bad.write.mode("overwrite").parquet(f"{dlq_path}/batch_id={batch_id}")

    return parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_incremental_load(spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str, max_files: int | None = None) -> None:
    """Load files not loaded before and end. The checkpoint remembers files, so a second run over
    the same folder adds nothing, and an hour without files is a run without rows.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path).withColumn("_ingest_date", F.current_date())
    writer = rows.writeStream.format("parquet").partitionBy("_ingest_date").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()


def stream_late_data(rows: DataFrame, ts: str, keys: list[str], limit: str = LATE_LIMIT) -> DataFrame:
    """First arrival per key within the limit; rows later than it are dropped and the state of older keys is freed."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, limit).dropDuplicatesWithinWatermark(keys)
