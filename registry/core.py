"""Registration of queries and assembly of their checking SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.history import scd2_snapshot
from fleetmart.plans import dims, facts
from fleetmart.session import run_dir, use_session
from fleetmart.sources import adapter

NOW = "2001-08-02 00:00:00"
SNAPSHOT_NOW = "2026-06-01 00:00:00"
FIRST_LOAD = "1992-01-01 00:00:00"
SECOND_LOAD = "1995-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = dict(adapter.TABLES)


def now(text: str = NOW):
    return F.lit(text).cast("timestamp")


def today(text: str = NOW):
    return F.lit(text[:10]).cast("date")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand out the same kind of value."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


class Data:
    """Lazy bronze and silver tables of one test folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = use_session(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name in adapter.BASE_TABLES:
                self._tables[name] = adapter.base(self.spark, self.sf_dir, name)
            else:
                inputs = {t: self.table(t) for t in adapter.inputs_of(name)}
                self._tables[name] = self.spark.sql(adapter.TABLES[name], **inputs)
        return self._tables[name]

    @cached_property
    def zones(self) -> DataFrame:
        return dims.dim_zones(self.table("zones"))

    @cached_property
    def vehicle_types(self) -> DataFrame:
        return dims.dim_vehicle_types(self.table("vehicle_types"))

    @cached_property
    def driver_history(self) -> DataFrame:
        return scd2_snapshot(None, self.table("drivers"), "driver_id", "updated_at", now(SNAPSHOT_NOW))

    @cached_property
    def passenger_history(self) -> DataFrame:
        return scd2_snapshot(None, self.table("passengers"), "passenger_id", "updated_at", now(SNAPSHOT_NOW))

    @cached_property
    def drivers(self) -> DataFrame:
        return dims.dim_drivers(self.driver_history, self.vehicle_types, self.zones)

    @cached_property
    def passengers(self) -> DataFrame:
        return dims.dim_passengers(self.passenger_history, self.zones, today(SNAPSHOT_NOW))

    def _loads(self, table: str, key: str, status: str) -> DataFrame:
        """History of three extracts: a first load, a change of two thirds some years later, and today's rows."""
        rows, k = self.table(table), F.substring(key, 3, 20).cast("long")
        first = rows.withColumns({"updated_at": F.lit(FIRST_LOAD).cast("timestamp"), "status": F.lit("PENDING")})
        later = F.lit(SECOND_LOAD).cast("timestamp") + F.make_dt_interval(days=(k % 700).cast("int"))
        second = first.withColumns({"updated_at": F.when(k % 3 != 0, later).otherwise(F.col("updated_at")), "status": F.when(k % 3 != 0, status).otherwise(F.col("status"))})
        history = scd2_snapshot(None, first, key, "updated_at", now(SNAPSHOT_NOW))
        for load in (second, rows):
            history = scd2_snapshot(history, load, key, "updated_at", now(SNAPSHOT_NOW))
        return history

    @cached_property
    def driver_versions(self) -> DataFrame:
        return self._loads("drivers", "driver_id", "SUSPENDED")

    @cached_property
    def passenger_versions(self) -> DataFrame:
        return self._loads("passengers", "passenger_id", "BANNED")

    @cached_property
    def rides(self) -> DataFrame:
        return facts.fct_rides(self.table("rides"), self.drivers, self.passengers, self.zones, self.vehicle_types)

    @cached_property
    def ride_events(self) -> DataFrame:
        return facts.fct_ride_events(self.table("ride_events"), self.ride_context)

    @cached_property
    def ride_context(self) -> DataFrame:
        return facts.ride_context(self.table("rides"))

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """A table written once to the shared folder, for jobs that read it several times."""
        path = run_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def query(name: str, sql: str | None = None):
    """Registers ``build(data)`` under a name; ``sql`` may use ``{cte}`` for any bronze or silver table."""

    def register(build: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(build(Data(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


_MARK = re.compile(r"\{([a-z]\w*)\}")


def assemble(sql: str) -> str:
    """A self-contained statement: every ``{cte}`` the text reaches is put in front, inputs first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _MARK.findall(text):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    named = lambda text: _MARK.sub(lambda m: m.group(1), text).strip()
    if not ordered:
        return named(sql)
    heads = ",\n".join(f"{n} AS (\n{named(CTES[n])}\n)" for n in ordered)
    body = named(sql)
    if re.match(r"(?i)with\s+recursive\s", body):
        return f"WITH RECURSIVE {heads},\n{body[len('with recursive'):].strip()}"
    if re.match(r"(?i)with\s", body):
        return f"WITH {heads},\n{body[4:].strip()}"
    return f"WITH {heads}\n{body}"


def r(expr: str, places: int = 0) -> str:
    """Rounding text for the checking database, through the same decimal."""
    return f"cast(round(cast({expr} AS decimal(28,8)), {places}) AS double)"


def avg(expr: str) -> str:
    return f"(cast(sum({expr}) AS double) / nullif(cast(count({expr}) AS double), 0))"


def pct(part: str, whole: str, places: int = 2) -> str:
    return r(f"cast({part} AS double) / nullif(cast({whole} AS double), 0) * 100.0::double", places)


def n(expr: str) -> str:
    return f"cast({expr} AS bigint)"
