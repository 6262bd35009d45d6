"""Data-quality checks. Each returns the failing rows; no row means the check passes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.cleaning import is_canonical_phone
from fleetmart.functions.domain import ALLOWED_TRANSITIONS
from fleetmart.operators.sequence import row_slices, with_neighbour

# Age of the newest row in hours at which a table warns and fails.
FRESHNESS_HOURS = (2, 6)
LOOKUP_FRESHNESS_HOURS = (24, 72)


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _true(condition: Column) -> Column:
    """NULL comparisons do not count as failures."""
    return F.coalesce(condition, F.lit(False))


def fare_is_inconsistent() -> Column:
    status, total = F.col("ride_status"), F.col("total_fare")
    negative = [F.col(c) < 0 for c in ("base_fare", "distance_fare", "time_fare", "total_fare")]
    return _true(_any([(status == "COMPLETED") & (total <= 0), *negative, (status == "CANCELLED") & (total > 0)]))


def timestamps_are_disordered() -> Column:
    steps = ["requested_at", "accepted_at", "picked_up_at", "completed_at"]
    return _any([_true(F.col(later) < F.col(earlier)) for earlier, later in zip(steps, steps[1:])])


def dq_fare_consistency(rides: DataFrame) -> DataFrame:
    return rides.filter(fare_is_inconsistent()).select("ride_id", "ride_status", "base_fare", "distance_fare", "time_fare", "total_fare")


def dq_timestamp_order(rides: DataFrame) -> DataFrame:
    return rides.filter(timestamps_are_disordered()).select(
        "ride_id", "ride_code", "ride_status", "requested_at", "accepted_at", "picked_up_at", "completed_at"
    )


def dq_phone_canonical(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~is_canonical_phone(F.col(column))).select(column)


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-NULL values with their count; counted before the shuffle, so a hot value is one row per task."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def dq_accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Non-NULL values outside the list, with their count."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def out_of_range(column: str, low: float | None, high: float | None) -> Column:
    bounds = []
    if low is not None:
        bounds.append(F.col(column) < low)
    if high is not None:
        bounds.append(F.col(column) > high)
    return _true(_any(bounds))


def dq_accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.filter(out_of_range(column, low, high))


def dq_freshness(df: DataFrame, table: str, loaded_at: str, now: Column, limits: tuple[int, int] = FRESHNESS_HOURS) -> DataFrame:
    """One row: newest load, its age in hours and pass, warn or error. A table without rows is an error."""
    newest = F.max(loaded_at)
    age = F.timestamp_diff("SECOND", newest, now) / F.lit(3600.0)
    warn, error = limits
    state = F.when(newest.isNull() | (age > error), "error").when(age > warn, "warn").otherwise("pass")
    return df.agg(newest.alias("max_loaded_at"), age.alias("age_hours"), state.alias("status")).select(F.lit(table).alias("table_name"), "*")


@dataclass(frozen=True)
class Rule:
    """A row-level check: rows where ``fails`` is true are counted."""

    name: str
    column: str
    fails: Column


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: list[str]) -> Rule:
    return Rule("accepted_values", column, _true(~F.col(column).isin(values)))


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    return Rule("accepted_range", column, out_of_range(column, low, high))


def repeated_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of repeated values per column. The columns are laid out as (column, value) rows, so one pass counts all; each
    value is counted before the shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(pairs).alias("_p")).select("_p.*").filter("value IS NOT NULL")
    repeated = values.groupBy("column_name", "value").agg((F.count("*") > 1).alias("again"))
    found = repeated.groupBy("column_name").agg(F.count_if("again").alias("failing"))
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return named.join(F.broadcast(found), "column_name", "left").select(
        F.lit("unique").alias("check_name"), "column_name", F.coalesce("failing", F.lit(0)).alias("failing")
    )


def dq_report(df: DataFrame, table: str, rules: list[Rule], unique: list[str] = ()) -> DataFrame:
    """One row per check with its failing count. Row-level rules share one pass over the table, uniqueness rules another."""
    counts = df.agg(*[F.count_if(r.fails).alias(f"_c{i}") for i, r in enumerate(rules)])
    lines = F.array(
        *[F.struct(F.lit(r.name).alias("check_name"), F.lit(r.column).alias("column_name"), F.col(f"_c{i}").alias("failing")) for i, r in enumerate(rules)]
    )
    report = counts.select(F.explode(lines).alias("_l")).select("_l.*")
    if unique:
        report = report.unionByName(repeated_values(df, unique))
    return report.select(F.lit(table).alias("table_name"), "*", (F.col("failing") == 0).alias("passed"))


def suite(lines: list[tuple]) -> tuple[list[Rule], list[str]]:
    """(row rules, unique columns) of declared checks: (kind, column, values or bounds)."""
    kinds = {"not_null": not_null, "accepted_values": accepted_values, "accepted_range": accepted_range}
    return [kinds[kind](column, *args) for kind, column, *args in lines if kind != "unique"], [column for kind, column, *_ in lines if kind == "unique"]


def dq_report_all(suites: dict[str, tuple[DataFrame, tuple[list[Rule], list[str]]]]) -> DataFrame:
    """The reports of several tables in one: a row per table and check."""
    out = None
    for table, (df, (rules, unique)) in suites.items():
        report = dq_report(df, table, rules, unique)
        out = report if out is None else out.unionByName(report)
    return out


def dq_transition_legality(
    log: DataFrame, key: str = "ride_id", status: str = "status", ts: str = "ts", tie: str = "event_id",
    allowed: list[tuple[str, str]] = ALLOWED_TRANSITIONS, slice_by: Column | None = None,
) -> DataFrame:
    """Status changes outside the allowed pairs, including any change after a terminal status."""
    cut = row_slices(log, ts) if slice_by is None else slice_by
    steps = with_neighbour(log, [key], [ts, tie], {"previous_status": status}, cut, previous=True)
    legal = _any([(F.col("previous_status") == a) & (F.col(status) == b) for a, b in allowed])
    return steps.filter(F.col("previous_status").isNotNull() & ~legal)


# Checks the pipeline names without giving a body ---------------------------------------------------------------------


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    return child.filter(F.col(column).isNotNull()).join(parent.select(column), column, "left_anti")


def not_exactly_one(parent: DataFrame, child: DataFrame, column: str) -> DataFrame:
    """Parents without exactly one child; children are counted per key before the join."""
    counted = child.groupBy(column).agg(F.count("*").alias("children"))
    return parent.select(column).join(counted, column, "left").withColumn("children", F.coalesce("children", F.lit(0))).filter("children <> 1")


def scd2_overlaps(history: DataFrame, key: str, slice_by: Column | None = None) -> DataFrame:
    """Versions that end after the next one starts, or stay open although a next one exists."""
    cut = row_slices(history, "valid_from") if slice_by is None else slice_by
    chained = with_neighbour(history, [key], ["valid_from"], {"next_from": "valid_from"}, cut)
    return chained.filter(F.col("next_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_from"))))


def both_set(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.filter(F.col(first) & F.col(second))


def payment_amount_mismatch(payments: DataFrame, discount_limit: float) -> DataFrame:
    """Payments whose fee and earning do not add up to the amount, or whose discount exceeds the limit."""
    off = F.col("platform_fee") + F.col("driver_earning") != F.col("amount")
    return payments.filter(_true(off) | _true(F.col("promo_discount") > discount_limit))


def dates_outside(df: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def uncovered_days(fact: DataFrame, mart: DataFrame, fact_day: str, mart_day: str, mart_count: str) -> DataFrame:
    """Days on which a mart's total differs from the fact's row count."""
    a = fact.groupBy(F.col(fact_day).alias("day")).agg(F.count("*").alias("fact_rows"))
    b = mart.groupBy(F.col(mart_day).alias("day")).agg(F.sum(mart_count).alias("mart_rows"))
    return a.join(b, "day", "full_outer").filter(~F.col("fact_rows").eqNullSafe(F.col("mart_rows")))
