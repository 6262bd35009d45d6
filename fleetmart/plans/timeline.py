"""Per-trip status timeline from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.calendar import minutes_between, seconds_between
from fleetmart.operators.sequence import row_slices, with_neighbour

# Status codes of the timeline with their output column, and the limits of the cancel classes in minutes.
TIMELINE_STATUSES = [
    ("requested", "ts_requested"),
    ("driver_accepted", "ts_driver_accepted"),
    ("driver_arrived", "ts_driver_arrived"),
    ("trip_started", "ts_trip_started"),
    ("completed", "ts_trip_completed"),
    ("cancelled", "ts_trip_cancelled"),
]
NO_SHOW_MINUTES = 5
EARLY_MINUTES = 3
LONG_WAIT_MINUTES = 15


def earliest_per_status(events: DataFrame, key: str = "trip_id", status: str = "status_code", ts: str = "event_ts") -> DataFrame:
    """First time each status was seen, one row per trip; also the stateful form for a stream."""
    firsts = [F.min(F.when(F.col(status) == code, F.col(ts))).alias(name) for code, name in TIMELINE_STATUSES]
    return events.groupBy(key).agg(*firsts)


def cancel_pattern() -> Column:
    cancelled, arrived, accepted = F.col("ts_trip_cancelled"), F.col("ts_driver_arrived"), F.col("ts_driver_accepted")
    after_accept = minutes_between(accepted, cancelled)
    kind = (
        F.when(minutes_between(arrived, cancelled) <= NO_SHOW_MINUTES, "no_show")
        .when(after_accept <= EARLY_MINUTES, "early_cancel")
        .when(after_accept > LONG_WAIT_MINUTES, "long_wait_cancel")
        .otherwise("normal_cancel")
    )
    return F.when(cancelled.isNotNull(), kind)


def with_durations(timeline: DataFrame) -> DataFrame:
    spans = {
        "sec_request_to_accepted": ("ts_requested", "ts_driver_accepted"),
        "sec_accepted_to_arrived": ("ts_driver_accepted", "ts_driver_arrived"),
        "sec_arrived_to_started": ("ts_driver_arrived", "ts_trip_started"),
        "sec_trip_duration": ("ts_trip_started", "ts_trip_completed"),
        "sec_accepted_to_cancelled": ("ts_driver_accepted", "ts_trip_cancelled"),
    }
    out = {name: seconds_between(F.col(a), F.col(b)) for name, (a, b) in spans.items()}
    return timeline.withColumns({**out, "cancel_pattern": cancel_pattern()})


def fct_trip_status_timeline(events: DataFrame) -> DataFrame:
    """Timeline, durations and cancel class; ``events`` are change events already limited to creates and updates."""
    return with_durations(earliest_per_status(events))


def status_durations(log: DataFrame, key: str, ts: str, tie: str, slice_by: Column | None = None) -> DataFrame:
    """Minutes from each status to the next one of the same trip; NULL on the last."""
    cut = row_slices(log, ts) if slice_by is None else slice_by
    chained = with_neighbour(log, [key], [ts, tie], {"next_ts": ts}, cut)
    return chained.withColumn("minutes_to_next", minutes_between(F.col(ts), F.col("next_ts")))
