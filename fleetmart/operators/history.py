"""Slowly changing history: snapshots, current and as-of views, transitions, versions from a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.keys import surrogate_key, utc_text
from fleetmart.operators.asof import version_at
from fleetmart.operators.dedup import latest_per_key
from fleetmart.operators.sequence import row_slices, with_neighbour
from fleetmart.session import run_dir

VERSION_COLUMNS = ["scd_id", "scd_updated_at", "valid_from", "valid_to"]


def _opened(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    return source.withColumns(
        {
            "scd_id": surrogate_key(F.col(key), utc_text(F.col(updated_at))),
            "scd_updated_at": F.col(updated_at),
            "valid_from": F.col(updated_at),
            "valid_to": F.lit(None).cast("timestamp"),
        }
    )


def scd2_step(open_rows: DataFrame, source: DataFrame, key: str, updated_at: str, now: Column, hard_deletes: bool = True) -> DataFrame:
    """Open versions met with a fresh extract: kept, closed and newly opened versions.

    Needs only the open versions, so closed history is not read or rewritten.
    """
    fresh = _opened(latest_per_key(source, [key], [updated_at]), key, updated_at)
    columns = fresh.columns
    left = open_rows.select(F.col(key).alias("_ok"), F.struct(*columns).alias("_o"))
    right = fresh.select(F.col(key).alias("_nk"), F.struct(*columns).alias("_n"))
    pair = left.join(right, F.col("_ok") == F.col("_nk"), "full_outer")
    gone = F.col("_n").isNull()
    changed = F.coalesce(F.col(f"_n.{updated_at}") > F.col("_o.valid_from"), F.lit(False))
    end = F.when(changed, F.col(f"_n.{updated_at}"))
    if hard_deletes:
        end = F.when(gone, now).otherwise(end)
    ended = F.when(F.col("_o").isNotNull(), F.col("_o").withField("valid_to", end))
    started = F.when(F.col("_o").isNull() | changed, F.col("_n"))
    rows = F.filter(F.array(ended, started), lambda r: r.isNotNull())
    return pair.select(F.explode(rows).alias("_r")).select(*[F.col(f"_r.{c}") for c in columns])


def scd2_snapshot(
    history: DataFrame | None, source: DataFrame, key: str, updated_at: str, now: Column, hard_deletes: bool = True
) -> DataFrame:
    """Timestamp-strategy snapshot: the whole history after one more extract."""
    if history is None:
        return _opened(latest_per_key(source, [key], [updated_at]), key, updated_at)
    closed = history.filter("valid_to IS NOT NULL")
    stepped = scd2_step(history.filter("valid_to IS NULL"), source, key, updated_at, now, hard_deletes)
    return closed.unionByName(stepped)


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter("valid_to IS NULL").withColumn("is_current", F.lit(True))


def scd2_versions(history: DataFrame) -> DataFrame:
    """All versions, with a mark on the open ones."""
    return history.withColumn("is_current", F.col("valid_to").isNull())


def scd2_as_of(history: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at one moment."""
    return history.filter((F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to"))))


def _hidden(history: DataFrame, key: str, rows_per_slice: int | None) -> DataFrame:
    """Versions that outlast the beginning of the next one, from that moment on; written, as the next step reads them again."""
    ended = history.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).withColumn("__end", F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp")))
    chained = with_neighbour(ended, [key], ["valid_from", "__end"], {"__next": "valid_from"}, row_slices(ended, "valid_from", rows_per_slice))
    hidden = chained.where("__end > __next").withColumn("valid_from", F.col("__next")).drop("__end", "__next")
    path = run_dir(history.sparkSession, "hidden-versions")
    hidden.write.parquet(path)
    return history.sparkSession.read.schema(hidden.schema).parquet(path)


def scd2_as_of_each(history: DataFrame, probes: DataFrame, key: str, at: str, rows_per_slice: int | None = None) -> DataFrame:
    """Each probe row with the version valid at its own moment; probes without one are dropped.

    A sweep over versions and probes (``version_at``) finds the version that began last. Where versions overlap, what is
    hidden behind a later one is swept again, once for every further version valid at the same time, so all are found.
    Columns of the probes come first, then those of the version but its key.
    """
    values = {c: F.col("__began" if c == "valid_from" else c) for c in history.columns if c != key}
    left = history.withColumn("__began", F.col("valid_from"))
    found = version_at(probes, left, key, key, at, values, keep_unmatched=False, rows_per_slice=rows_per_slice)
    left = _hidden(left, key, rows_per_slice)
    while not left.isEmpty():
        found = found.unionByName(version_at(probes, left, key, key, at, values, keep_unmatched=False, rows_per_slice=rows_per_slice))
        left = _hidden(left, key, rows_per_slice)
    return found


def with_version(
    rows: DataFrame, history: DataFrame, row_key: str, key: str, at: str, values: dict[str, Column], spread_by: str | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Every row with values of the version valid at its moment, NULL if there is none.

    The first version of a key also holds for all that came before it. ``values`` are columns over the history.
    """
    return version_at(rows, history, row_key, key, at, values, True, spread_by=spread_by, rows_per_slice=rows_per_slice)


def with_previous_value(history: DataFrame, key: str, attribute: str, order: list[str] | None = None, slice_by: Column | None = None) -> DataFrame:
    """Adds ``previous_<attribute>`` of the version before."""
    cut = row_slices(history, "valid_from") if slice_by is None else slice_by
    return with_neighbour(
        history, [key], order or ["valid_from"], {f"previous_{attribute}": attribute}, cut, previous=True
    )


def scd2_transitions(
    history: DataFrame, key: str, attribute: str, start: Column, end: Column, slice_by: Column | None = None, order: list[str] | None = None
) -> DataFrame:
    """How often each (from, to) change of an attribute happened in [start, end)."""
    steps = with_previous_value(history, key, attribute, order, slice_by)
    before = F.col(f"previous_{attribute}")
    moved = steps.filter(before.isNotNull() & (before != F.col(attribute)))
    inside = moved.filter((F.col("valid_from") >= start) & (F.col("valid_from") < end))
    return inside.groupBy(before.alias("from_value"), F.col(attribute).alias("to_value")).agg(
        F.count("*").alias("transitions"), F.count_distinct(key).alias("entities")
    )


def changed_more_than_once(history: DataFrame, key: str, attribute: str, slice_by: Column | None = None, order: list[str] | None = None) -> DataFrame:
    steps = with_previous_value(history, key, attribute, order, slice_by)
    moved = F.col(f"previous_{attribute}").isNotNull() & (F.col(f"previous_{attribute}") != F.col(attribute))
    return steps.filter(moved).groupBy(key).agg(F.count("*").alias("changes")).filter("changes > 1")


def first_time(history: DataFrame, key: str, condition: Column) -> DataFrame:
    """When an entity first met a condition."""
    return history.filter(condition).groupBy(key).agg(F.min("valid_from").alias("first_at"))


def scd2_from_changes(changes: DataFrame, key: str, ts: str = "ts", lsn: str = "lsn", op: str = "op", slice_by: Column | None = None) -> DataFrame:
    """Every version in a change log: valid from its event to the next one.

    Events at the same instant count as one version, the last by log position. A delete ends the version before it and
    opens none.
    """
    distinct = latest_per_key(changes, [key, ts], [lsn])
    cut = row_slices(distinct, ts) if slice_by is None else slice_by
    chained = with_neighbour(distinct, [key], [ts, lsn], {"valid_to": ts}, cut)
    return chained.filter(F.col(op) != "d").withColumn("valid_from", F.col(ts)).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def high_water_mark(df: DataFrame, columns: list[str], floor: Column) -> DataFrame:
    """The greatest of the columns' maxima, at least ``floor``; one row, also for an empty table."""
    marks = [F.coalesce(F.max(c), floor) for c in columns]
    return df.agg((F.greatest(*marks) if len(marks) > 1 else marks[0]).alias("high_water_mark"))
