"""Files clustered by up to four columns at once, along a space-filling curve.

A column's value becomes the number of its quantile range; the bits of these numbers are interleaved, and the rows are
range-partitioned and sorted by the result. Every file and row group then spans a small part of each column, so a filter
on any of them skips most row groups, not only a filter on the first sort column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.sequence import placed

BITS = 8
MOST_COLUMNS = 4
_PREFIX_BYTES = 7


def ordinal(df: DataFrame, column: str) -> Column:
    """A whole or real number in the order of the column; text by its first seven bytes."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, _PREFIX_BYTES)), 2 * _PREFIX_BYTES, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.BooleanType):
        return value.cast("long")
    return value.cast("double")


def curve_position(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The place of a row on the curve. The ranges of all columns are found in one pass; NULL stands before all values."""
    if not 1 <= len(columns) <= MOST_COLUMNS:
        raise ValueError(f"between one and {MOST_COLUMNS} columns, got {len(columns)}")
    numbers = {c: ordinal(df, c) for c in columns}
    parts = (1 << bits) - 1
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    found = df.agg(*[F.percentile_approx(n, shares, F.lit(100 * parts)).alias(f"c{i}") for i, n in enumerate(numbers.values())]).first()
    place = F.lit(0).cast("long")
    for i, n in enumerate(numbers.values()):
        cuts = sorted(set(found[f"c{i}"] or []))
        # Number 0 is for NULL; as many ranges as there are different cuts, at most 2^bits - 1.
        rank = F.when(n.isNull(), F.lit(0).cast("long")).otherwise(placed(n, cuts, str(df.select(n.alias("n")).schema["n"].dataType.simpleString())) + 1)
        for b in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long")), b * len(columns) + i))
    return place


def write_curve(df: DataFrame, path: str, columns: list[str], rows_per_file: int = 1_000_000, bits: int = BITS, mode: str = "overwrite") -> None:
    """Writes the rows along the curve of the columns, in files of about so many rows."""
    files = max(1, -(-df.count() // rows_per_file))
    placed_rows = df.withColumn("__curve", curve_position(df, columns, bits))
    placed_rows.repartitionByRange(files, "__curve").sortWithinPartitions("__curve").drop("__curve").write.mode(mode).parquet(path)
