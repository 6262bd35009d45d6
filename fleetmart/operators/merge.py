"""Upserts as DataFrame rewrites: target and source in, the new state out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators.dedup import latest_per_key


class SchemaConflict(ValueError):
    """A column changed its type; only added columns are accepted."""


def evolve_schema(target: DataFrame, incoming: DataFrame) -> tuple[DataFrame, str]:
    """Target widened by the columns only ``incoming`` has, and ``no_changes`` or ``added:a,b``."""
    have = {f.name: f.dataType for f in target.schema}
    clash = [f.name for f in incoming.schema if f.name in have and have[f.name] != f.dataType]
    if clash:
        raise SchemaConflict(f"type change refused for: {', '.join(clash)}")
    new = [f for f in incoming.schema if f.name not in have]
    if not new:
        return target, "no_changes"
    widened = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})
    return widened, "added:" + ",".join(f.name for f in new)


def _paired(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Full outer pairing: ``_t`` and ``_s`` hold the whole rows, NULL when a side has none."""
    target, _ = evolve_schema(target, source)
    columns = target.columns
    source, _ = evolve_schema(source, target)
    left = target.select(*[F.col(k).alias(f"_tk{i}") for i, k in enumerate(keys)], F.struct(*columns).alias("_t"))
    right = source.select(*[F.col(k).alias(f"_sk{i}") for i, k in enumerate(keys)], F.struct(*columns).alias("_s"))
    on = [F.col(f"_tk{i}") == F.col(f"_sk{i}") for i in range(len(keys))]
    return left.join(right, on, "full_outer"), columns


def _later(source: str, target: str, order_cols: list[str]):
    """True where the source row is provably later: the first differing order column decides, and a NULL decides nothing."""
    later, equal = F.lit(False), F.lit(True)
    for c in order_cols:
        s, t = F.col(f"{source}.{c}"), F.col(f"{target}.{c}")
        later = later | (equal & (s > t))
        equal = equal & s.eqNullSafe(t)
    return F.coalesce(later, F.lit(False))


def merge_if_newer(target: DataFrame, source: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Matched rows take the source row when it is newer, unmatched source rows are added.

    A source row is newer if the comparison says so: where either side of it is NULL, the target row stays.
    """
    paired, columns = _paired(target, latest_per_key(source, keys, order_cols), keys)
    take_source = F.col("_t").isNull() | (F.col("_s").isNotNull() & _later("_s", "_t", order_cols))
    row = F.when(take_source, F.col("_s")).otherwise(F.col("_t"))
    return paired.select(row.alias("_r")).select(*[F.col(f"_r.{c}") for c in columns])


def merge_overwrite(target: DataFrame, source: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Matched rows always take the source row, unmatched source rows are added."""
    if order_cols:
        source = latest_per_key(source, keys, order_cols)
    paired, columns = _paired(target, source, keys)
    return paired.select(F.coalesce("_s", "_t").alias("_r")).select(*[F.col(f"_r.{c}") for c in columns])


def merge_append_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The source rows whose key the target lacks: what an immutable log appends. Existing rows are left alone."""
    fresh = latest_per_key(source, keys, [])
    return fresh.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def merge_delete_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is still in the source; applied before a merge when deletes are wanted."""
    return target.join(source.select(*keys).distinct(), keys, "left_semi").select(*target.columns)


def incremental_merge(target: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Fact upsert by unique key: rebuilt rows replace their earlier form."""
    return merge_overwrite(target, fresh, keys)
