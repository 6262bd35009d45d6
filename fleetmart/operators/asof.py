"""The version valid at many moments: a sweep over versions and probes together.

Versions and probes of a key are put in one order of time, and every probe takes the last version before it. Rows are
sorted per (key, slice of time); a slice has a bounded number of rows, and what is open at its start comes from a small
table with one row per (key, slice). The cost is versions plus probes, never their product, also for one key that holds
most of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.operators.joins import common_type
from fleetmart.operators.sequence import placed, time_cuts

#: Rows without a key match nothing; they are dealt to so many groups.
SPREAD = 1024
FOREVER = 2**63 - 1


def version_at(
    rows: DataFrame, history: DataFrame, row_key: str, key: str, at: str, values: dict[str, Column], first_holds_before: bool = False,
    keep_unmatched: bool = True, spread_by: str | None = None, rows_per_slice: int | None = None,
) -> DataFrame:
    """Every row with ``values`` (columns over ``history``) of the version with valid_from <= at < valid_to.

    An open version has no valid_to. Of versions that begin together the one that ends last counts, and one that begins
    later hides the one before it. With ``first_holds_before`` the first version of a key also holds for all that came before. Rows
    without a version get NULLs, or are left out without ``keep_unmatched``; a NULL key or moment has no version. Keys are compared in their common type.
    """
    kind = common_type(rows, row_key, history, key)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    version = F.struct(us("valid_to").alias("_to"), *[c.alias(n) for n, c in values.items()])
    known = history.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
    known = known.select(
        F.col(key).cast(kind).alias("__k"), F.lit(0).cast("long").alias("__spread"), us("valid_from").alias("__us"), F.lit(0).alias("__probe"),
        F.coalesce(us("valid_to"), F.lit(FOREVER)).alias("__to"), version.alias("__version"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema],
    )
    spread = F.when(F.col(row_key).isNull(), F.pmod(F.xxhash64(*([spread_by] if spread_by else rows.columns)), F.lit(SPREAD)) + 1).otherwise(F.lit(0).cast("long"))
    probes = rows.select(
        F.col(row_key).cast(kind).alias("__k"), spread.alias("__spread"), us(at).alias("__us"), F.lit(1).alias("__probe"),
        F.lit(None).cast("long").alias("__to"), F.lit(None).cast(known.schema["__version"].dataType).alias("__version"), *rows.columns,
    )
    events = known.unionByName(probes)
    cuts = time_cuts(events, F.col("__us"), rows_per_slice)
    order = [F.col("__us").asc_nulls_first(), "__probe", "__to"]
    last = lambda w: F.last("__version", ignorenulls=True).over(w)
    group = ["__k", "__spread"]
    if cuts:
        # Moments without a time stay apart: no version is carried to them.
        events = events.withColumn("__slice", F.when(F.col("__us").isNotNull(), placed(F.col("__us"), cuts)))
        inside = Window.partitionBy(*group, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        place = F.when(F.col("__probe") == 0, F.struct("__us", "__to"))
        edges = events.groupBy(*group, "__slice").agg(F.max_by("__version", place).alias("__last"), F.min_by("__version", place).alias("__head"))
        across = Window.partitionBy(*group).orderBy(F.col("__slice").asc_nulls_first())
        carried = edges.select(
            *group, "__slice", F.last("__last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("__open"),
            F.first("__head", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__first"),
        )
        swept = events.withColumn("__inside", last(inside)).where("__probe = 1").join(carried, [*group, "__slice"], "left")
        found = swept.withColumn("__found", F.coalesce("__inside", "__open"))
    else:
        whole = Window.partitionBy(*group).orderBy(*order)
        found = events.withColumn("__found", last(whole.rowsBetween(Window.unboundedPreceding, 0)))
        if first_holds_before:
            found = found.withColumn("__first", F.first("__version", ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        found = found.where("__probe = 1")
    end = F.col("__found._to")
    valid = F.when(F.col("__us").isNotNull() & (end.isNull() | (F.col("__us") < end)), F.col("__found"))
    if first_holds_before:
        valid = F.when(F.col("__found").isNull() & F.col("__us").isNotNull(), F.col("__first")).otherwise(valid)
    out = found.withColumn("__valid", valid)
    if not keep_unmatched:
        out = out.where(F.col("__valid").isNotNull())
    return out.select(*rows.columns, *[F.col("__valid").getField(n).alias(n) for n in values])
