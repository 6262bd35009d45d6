"""Extract-side projections and filters, and the per-table ingest."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.dedup import latest_per_key
from fleetmart.operators.merge import evolve_schema, merge_append_only, merge_if_newer
from fleetmart.sources.contracts import TYPE_MAP, TableSpec

SOURCE_TZ = "Asia/Jakarta"


def parse_columns(text: str, known: dict[str, str]) -> list[str]:
    """Names from a comma or newline separated list; unknown names are refused before any work starts."""
    names = [c.strip() for c in text.replace("\n", ",").split(",") if c.strip()]
    unknown = [c for c in names if c not in known]
    if unknown:
        raise ValueError(f"columns not declared in the schema: {', '.join(unknown)}")
    return names


def declared_columns(spec: TableSpec) -> list[str]:
    return parse_columns(spec.columns, spec.types) if spec.columns else list(spec.types)


def select_declared_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*declared_columns(spec))


def normalise_timestamp(df: DataFrame, column: str, source_tz: str = SOURCE_TZ) -> Column:
    """A naive timestamp is read as local time of the source; one with a zone keeps its instant."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(column)
    return F.to_utc_timestamp(F.col(column).cast("timestamp"), source_tz)


def json_to_string(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.col(column) if isinstance(kind, T.StringType) else F.to_json(F.col(column))


def cast_to_contract(df: DataFrame, spec: TableSpec, source_tz: str = SOURCE_TZ) -> DataFrame:
    """Declared columns in their declared types. DATE and FLOAT64 pass through."""
    out = []
    for name in declared_columns(spec):
        kind = spec.types[name]
        if name in spec.json_cols:
            out.append(json_to_string(df, name).alias(name))
        elif kind in ("TIMESTAMP", "DATETIME"):
            out.append(normalise_timestamp(df, name, source_tz).alias(name))
        elif kind in ("DATE", "FLOAT64"):
            out.append(F.col(name))
        else:
            out.append(F.col(name).cast(TYPE_MAP[kind]).alias(name))
    return df.select(*out)


def add_ingest_metadata(df: DataFrame, source_system: str, now: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if now is None else now
    return df.withColumns({"_ingested_at": stamp, "_source_system": F.lit(source_system)})


def coalesce_source_system(df: DataFrame, default: str = "postgres") -> DataFrame:
    return df.withColumn("_source_system", F.coalesce("_source_system", F.lit(default)))


def _as_local_text(moment: datetime | str, tz: str) -> str:
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(ZoneInfo(tz)).strftime("%Y-%m-%d %H:%M:%S")


def window_bounds(
    start: datetime | str,
    end: datetime | str,
    tz: str = SOURCE_TZ,
    window_start: str | None = None,
    window_end: str | None = None,
) -> tuple[str, str]:
    """Local text of both ends. ``start``/``end`` are UTC; the two overrides are local already and win."""
    return window_start or _as_local_text(start, tz), window_end or _as_local_text(end, tz)


def window_filter(
    df: DataFrame,
    column: str,
    start: datetime | str,
    end: datetime | str,
    tz: str = SOURCE_TZ,
    window_start: str | None = None,
    window_end: str | None = None,
) -> DataFrame:
    """Half-open window [start, end). The column stays bare, so the bounds reach the scan."""
    low, high = window_bounds(start, end, tz, window_start, window_end)
    kind = df.schema[column].dataType

    def bound(text: str) -> Column:
        if isinstance(kind, T.TimestampType):
            return F.to_utc_timestamp(F.lit(text).cast("timestamp"), tz)
        if isinstance(kind, T.DateType):
            return F.lit(text[:10]).cast("date")
        return F.lit(text).cast("timestamp_ntz")

    return df.filter((F.col(column) >= bound(low)) & (F.col(column) < bound(high)))


def incremental_lookback(df: DataFrame, column: str, now: Column, days: int) -> DataFrame:
    """Rows touched within the last ``days`` days before ``now``."""
    return df.filter(F.col(column) >= now - F.make_dt_interval(days=F.lit(days)))


def recent_days(df: DataFrame, column: str, today: Column, days: int) -> DataFrame:
    return df.filter(F.col(column) >= F.date_sub(today, days))


def ingest_table(
    spec: TableSpec,
    source: DataFrame,
    target: DataFrame | None,
    start: datetime | str,
    end: datetime | str,
    now: Column,
    source_tz: str = SOURCE_TZ,
    window_start: str | None = None,
    window_end: str | None = None,
) -> DataFrame:
    """Windowed extract, typed projection, latest per key, schema evolution, upsert: the new state of the table."""
    extract = window_filter(source, spec.window_col, start, end, source_tz, window_start, window_end)
    typed = add_ingest_metadata(cast_to_contract(extract, spec, source_tz), spec.source_system, now)
    staged = latest_per_key(typed, [spec.key], list(spec.order_cols))
    if target is None:
        return staged
    widened, _ = evolve_schema(target, staged)
    if spec.append_only:
        return widened.unionByName(merge_append_only(widened, staged, [spec.key]), allowMissingColumns=True)
    return merge_if_newer(widened, staged, [spec.key], list(spec.order_cols))


def required_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows missing a required column; the check made before a write."""
    bad = F.lit(False)
    for name in spec.required:
        bad = bad | F.col(name).isNull()
    return df.filter(bad)


