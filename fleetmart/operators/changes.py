"""Row-change events: unwrap, flatten, apply, compare with the application's own log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.functions import calendar
from fleetmart.operators.dedup import latest_per_key

# Operation codes of a change event.
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"


def cdc_unwrap(envelopes: DataFrame, drop_tombstones: bool = False) -> DataFrame:
    """Envelope -> flat row. A delete becomes its last row state flagged ``__deleted``; a tombstone (no envelope) is kept
    as a row of NULLs unless dropped. Stateless, so it serves batches and streams.
    """
    fields = envelopes.schema["after"].dataType.fieldNames()
    source = envelopes.schema["source"].dataType.fieldNames()
    row = F.when(F.col("op") == DELETE, F.col("before")).otherwise(F.col("after"))
    rows = envelopes.filter("op IS NOT NULL") if drop_tombstones else envelopes
    source_ts = F.col("source.ts_ms") if "ts_ms" in source else F.col("ts_ms")
    return rows.withColumn("_row", row).select(
        *[F.col(f"_row.{c}").alias(c) for c in fields],
        F.col("op").alias("__op"),
        source_ts.alias("__source_ts_ms"),
        F.col("source.table").alias("__table"),
        F.col("source.lsn").alias("__lsn"),
        (F.col("op") == DELETE).alias("__deleted"),
    )


def cdc_unwrap_documents(envelopes: DataFrame, document: T.StructType, key: str = "_id", drop_tombstones: bool = False) -> DataFrame:
    """The same for a document store, whose envelopes carry ``after`` as JSON text and name a collection.

    ``document`` is the shape the text is read with. A delete holds no document: its row has the key of the event, from
    the column of that name in the envelope, and NULLs. A text that cannot be read gives NULLs beside its key.
    """
    rows = envelopes.filter("op IS NOT NULL") if drop_tombstones else envelopes
    rows = rows.withColumn("_row", F.from_json("after", document))
    fields = [F.coalesce(F.col(f"_row.{f.name}"), F.col(key).cast(f.dataType)).alias(f.name) if f.name == key else F.col(f"_row.{f.name}").alias(f.name) for f in document]
    return rows.select(
        *fields, F.col("op").alias("__op"), F.col("source.ts_ms").alias("__source_ts_ms"), F.col("source.collection").alias("__collection"), (F.col("op") == DELETE).alias("__deleted")
    )


def cdc_flatten_before_after(envelopes: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per change with before and after values, event time and log position."""
    pairs = [F.col(f"{side}.{a}").alias(f"{a}_{side}") for a in attributes for side in ("before", "after")]
    return envelopes.select(
        "op",
        F.coalesce(f"after.{key}", f"before.{key}").alias(key),
        *pairs,
        F.timestamp_millis("ts_ms").alias("event_ts"),
        F.col("source.lsn").alias("lsn"),
    )


def op_filter(changes: DataFrame, ops: tuple[str, ...] = (CREATE, UPDATE), column: str = "op") -> DataFrame:
    return changes.filter(F.col(column).isin(*ops))


def snapshot_initial_read(table: DataFrame, changes: DataFrame, op: str = "op") -> DataFrame:
    """Existing rows as reads, followed by the change events. Columns a side lacks are NULL."""
    return table.withColumn(op, F.lit(READ)).unionByName(changes, allowMissingColumns=True)


def cdc_fold(changes: DataFrame, keys: list[str], order: tuple[str, ...] = ("__source_ts_ms", "__lsn")) -> DataFrame:
    """The last change per key, deletes included."""
    rows = changes.filter(F.col(keys[0]).isNotNull())
    return latest_per_key(rows, keys, list(order))


def cdc_apply(
    target: DataFrame | None, changes: DataFrame, keys: list[str], order: tuple[str, ...] = ("__source_ts_ms", "__lsn"),
    keep_deleted: bool = False,
) -> DataFrame:
    """Table state after the changes. The target carries its own change position, so replayed or late events that are
    older than the stored row change nothing. ``keep_deleted`` keeps delete markers for a further round.
    """
    pool = changes if target is None else target.unionByName(changes.select(*target.columns))
    last = cdc_fold(pool, keys, order)
    return last if keep_deleted else last.filter(~F.col("__deleted"))


def app_vs_log_lag(app_log: DataFrame, changes: DataFrame, key: str, status: str, app_ts: str, log_ts: str) -> DataFrame:
    """Seconds from the application's record of a status to the change event for it."""
    left = app_log.select(key, status, F.col(app_ts).alias("app_recorded_ts"))
    right = changes.select(key, status, F.col(log_ts).alias("wal_recorded_ts"))
    return left.join(right, [key, status]).withColumn(
        "lag_seconds", calendar.seconds_between(F.col("app_recorded_ts"), F.col("wal_recorded_ts"))
    )
