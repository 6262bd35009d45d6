"""Next and previous rows within a key, without sorting a whole key in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.operators.joins import scanned_bytes

ROWS_PER_SLICE = 1_000_000
#: Tables read from no more than this stay one slice; their rows are not counted.
ONE_SLICE_BYTES = 128 * 1024 * 1024
_BRANCHES = 32


def time_cuts(df: DataFrame, us: Column, rows_per_slice: int | None = None) -> list[int]:
    """Cuts of a time in microseconds into slices of about so many rows of the whole table, so that no key has more in one slice.

    They are quantiles, found in one pass; more rows than that stay together only where they carry one and the same time.
    One number per slice comes to the driver. Without a number of rows, a table read from few bytes has no cuts.
    """
    if rows_per_slice is None and scanned_bytes(df) <= ONE_SLICE_BYTES:
        return []
    parts = -(-df.count() // (rows_per_slice or ROWS_PER_SLICE))
    if parts < 2:
        return []
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    return sorted(set(df.agg(F.percentile_approx(us, shares, F.lit(100 * parts)).alias("cuts")).first()["cuts"] or []))


def placed(us: Column, cuts: list[int], kind: str = "bigint") -> Column:
    """Number of the cuts that are not above a value: nested branches, or two steps through an array (of type ``kind``) for many cuts."""

    def branch(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        return F.when(us >= cuts[mid], branch(mid + 1, hi)).otherwise(branch(lo, mid))

    if len(cuts) <= _BRANCHES:
        return branch(0, len(cuts))
    step = math.isqrt(len(cuts))
    listed = lambda numbers: F.array(*[F.lit(c).cast(kind) for c in numbers])
    reached = lambda some: F.size(F.filter(some, lambda c: c <= us)).cast("long")
    block = reached(listed(cuts[::step]))
    inside = reached(F.slice(listed(cuts), (F.greatest(block - 1, F.lit(0)) * step + 1).cast("int"), step))
    return F.when(block == 0, F.lit(0).cast("long")).otherwise((block - 1) * step + inside)


def row_slices(df: DataFrame, column: str, rows_per_slice: int | None = None) -> Column:
    """A slice for ``with_neighbour`` with about so many rows of the whole table (see ``time_cuts``)."""
    us = F.unix_micros(F.col(column).cast("timestamp"))
    cuts = time_cuts(df, us, rows_per_slice)
    return F.when(us.isNotNull(), placed(us, cuts)) if cuts else F.lit(0).cast("long")


def with_neighbour(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], slice_by: Column, previous: bool = False
) -> DataFrame:
    """Adds values of the next (or previous) row per key, in ``order``.

    ``values`` maps a new column to the column it is taken from. ``slice_by`` is a coarse, non-decreasing function of
    the order (such as its day or year, or ``row_slices``, which bounds the rows of a slice): rows are sorted per (key, slice) only, and the row at the edge of a slice takes
    the nearest row of the neighbouring slice from a small table with one row per (key, slice). The outcome equals a
    plain lead or lag; a key holding a large share of the rows is spread over its slices.
    """
    # Keys as text without NULL: the window and the join then ask for one and the same distribution, so the rows are
    # shuffled once.
    text = lambda column: F.coalesce(F.concat(F.lit("k"), column.cast("string")), F.lit("n"))
    parts = {f"_k{i}": text(F.col(k)) for i, k in enumerate(keys)}
    parts["_ks"] = text(slice_by)
    base = df.withColumns({**parts, "_slice": slice_by})
    packed = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    within = Window.partitionBy(*parts).orderBy(*order)
    across = Window.partitionBy(*[p for p in parts if p != "_ks"]).orderBy("_slice")
    position = F.struct(*order)
    if previous:
        inside, edge_row, hop = F.lag(packed).over(within), F.max_by(packed, position), F.lag("_edge").over(across)
    else:
        inside, edge_row, hop = F.lead(packed).over(within), F.min_by(packed, position), F.lead("_edge").over(across)
    edges = base.groupBy(*parts).agg(edge_row.alias("_edge"), F.min("_slice").alias("_slice"))
    beyond = edges.select(*parts, hop.alias("_beyond"))
    joined = base.withColumn("_inside", inside).join(beyond, list(parts), "left")
    found = F.coalesce("_inside", "_beyond")
    return joined.withColumns({n: found[n] for n in values}).select(*[c for c in df.columns if c not in values], *values)
