"""The application's own log against the change stream, both live."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import calendar


def stream_app_vs_log_lag(
    app_log: DataFrame, changes: DataFrame, key: str, status: str, app_ts: str, log_ts: str, apart: str = "1 hour", late: str = "10 minutes",
    unanswered: bool = False,
) -> DataFrame:
    """``app_vs_log_lag`` of two streams: seconds from the application's record of a status to the change event for it.

    Pairs are at most ``apart`` from each other, in either order; rows of both streams may come ``late`` after younger ones.
    The bound lets the state of both sides be freed once the slower stream has passed it. ``unanswered`` also gives records
    without a change event, with NULLs, as soon as none can come any more. Rows without a time or a key have no partner;
    they are not given.
    """
    left = app_log.select(key, status, F.col(app_ts).alias("app_recorded_ts")).where(F.col(key).isNotNull() & F.col("app_recorded_ts").isNotNull())
    right = changes.select(F.col(key).alias("_key"), F.col(status).alias("_status"), F.col(log_ts).alias("wal_recorded_ts"))
    right = right.where(F.col("_key").isNotNull() & F.col("wal_recorded_ts").isNotNull())
    span = F.expr(f"INTERVAL '{apart}'")
    near = F.col("wal_recorded_ts").between(F.col("app_recorded_ts") - span, F.col("app_recorded_ts") + span)
    pairs = left.withWatermark("app_recorded_ts", late).join(
        right.withWatermark("wal_recorded_ts", late), (F.col(key) == F.col("_key")) & (F.col(status) == F.col("_status")) & near, "left" if unanswered else "inner"
    )
    return pairs.select(
        key, status, "app_recorded_ts", "wal_recorded_ts", calendar.seconds_between(F.col("app_recorded_ts"), F.col("wal_recorded_ts")).alias("lag_seconds")
    )
