"""Hash keys over natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text standing for NULL inside a key, so (NULL, 'a') and ('a', NULL) differ.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 hex over the parts as text, joined by '-'."""
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def utc_text(ts: Column) -> Column:
    """A timestamp as key text, with the offset the warehouse prints."""
    return F.concat(ts.cast("string"), F.lit("+00"))


def integer_key(*parts: Column) -> Column:
    """A 60-bit integer key: the leading 15 hex digits of the md5 key.

    For dimensions; the natural key stays beside it, since among billions of keys two may meet.
    """
    return F.conv(F.substring(surrogate_key(*parts), 1, 15), 16, 10).cast("long")
