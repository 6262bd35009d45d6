"""Keyed state from change streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmart.operators.changes import cdc_apply, cdc_fold
from fleetmart.operators.sinks import path_exists, remove_path
from fleetmart.plans.timeline import TIMELINE_STATUSES, earliest_per_status, with_durations

ORDER = ("__source_ts_ms", "__lsn")


BASE = "_base"


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``prefix<number>`` below a path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hadoop) if f.isDirectory()]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def stream_apply(changes: DataFrame, path: str, checkpoint: str, keys: list[str], order: tuple[str, ...] = ORDER) -> StreamingQuery:
    """Keep the last change per key of each micro-batch under the batch's own folder.

    The cost of a batch follows the batch, not the table, and running a batch again overwrites its own folder. The table
    is the last change per key over the base and the batches after it (``applied_state``); ``compact`` folds them into a
    new base.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        cdc_fold(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _changes(spark: SparkSession, path: str) -> tuple[DataFrame, int, list[int], list[int]]:
    """(last changes, number of the last batch, batches, bases): the newest base and the batches after it."""
    bases, batches = _numbers(spark, f"{path}/{BASE}", "upto="), _numbers(spark, path, "batch_id=")
    base = bases[-1] if bases else -1
    folders = [f"{path}/{BASE}/upto={base}"] * (base >= 0) + [f"{path}/batch_id={n}" for n in batches if n > base]
    if not folders:
        raise FileNotFoundError(f"no finished batch below {path}")
    return spark.read.parquet(*folders), max([base, *batches]), batches, bases


def applied_state(spark: SparkSession, path: str, keys: list[str], order: tuple[str, ...] = ORDER, keep_deleted: bool = False) -> DataFrame:
    return cdc_apply(None, _changes(spark, path)[0], keys, order, keep_deleted)


def compact(spark: SparkSession, path: str, keys: list[str], order: tuple[str, ...] = ORDER) -> None:
    """Folds the base and the batches after it into a new base, and drops what it replaces.

    A base counts once its success mark stands, so a run that breaks off changes nothing; until the old folders are gone
    they are passed over, as the base says up to which batch it holds them. Delete markers stay, so that late older
    events have no effect.
    """
    _fold(spark, path, lambda rows: cdc_apply(None, rows, keys, order, True))


def _fold(spark: SparkSession, path: str, folded: Callable[[DataFrame], DataFrame]) -> None:
    rows, last, batches, bases = _changes(spark, path)
    folded(rows).write.mode("overwrite").parquet(f"{path}/{BASE}/upto={last}")
    for n in batches:
        if n <= last:
            remove_path(spark, f"{path}/batch_id={n}")
    for n in bases:
        if n < last:
            remove_path(spark, f"{path}/{BASE}/upto={n}")


def _earlier(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(*[F.min(c).alias(c) for _, c in TIMELINE_STATUSES])


def stream_trip_timeline(events: DataFrame, path: str, checkpoint: str, key: str = "trip_id") -> StreamingQuery:
    """Earliest time per trip and status of each micro-batch, under the batch's own folder.

    The earliest of all is the earliest of the batches' earliest, whatever their order and however often a batch is
    written, so the stream keeps no state, late events count whenever they come, and a batch costs what it holds.
    ``compact_timeline`` folds the batches into a base.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        earliest_per_status(batch, key).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def compact_timeline(spark: SparkSession, path: str, key: str = "trip_id") -> None:
    """Folds the base and the batches after it into a new base, one row per trip, and drops what it replaces."""
    _fold(spark, path, lambda rows: _earlier(rows, key))


def current_timeline(spark: SparkSession, path: str, key: str = "trip_id") -> DataFrame:
    return with_durations(_earlier(_changes(spark, path)[0], key))
