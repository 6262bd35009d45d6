"""Writes that check what they write: row rules are counted while the files are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators.quality import Rule, repeated_values
from fleetmart.operators.sinks import PARTITION_COLUMN, clustered, partition_value, point_table

REPORT = "table_name string, check_name string, column_name string, failing long, passed boolean"


def write_checked(
    df: DataFrame, path: str, table: str, rules: list[Rule], unique: list[str] = (), partition_col: str | None = None, grain: str = "MONTH",
    cluster_cols: list[str] = (), mode: str = "overwrite",
) -> DataFrame:
    """Writes ``df`` to ``path`` as Parquet and returns the report of ``quality.dq_report``, a row per check.

    The input is read and computed once: the rules are counted as metrics of the write itself. They stand after every
    shuffle of the write, so a task that is repeated on another executor is counted once. Uniqueness needs the rows
    of a value together; it reads only the named columns, and from the files written, so with ``mode="append"`` it speaks
    of the whole table while the rules speak of the rows written now. An empty input passes all checks.
    """
    staged = df
    if partition_col is not None:
        staged = clustered(df.withColumn(PARTITION_COLUMN, partition_value(partition_col, grain)), PARTITION_COLUMN, list(cluster_cols))
    seen = Observation()
    counts = [F.count_if(r.fails).alias(f"_c{i}") for i, r in enumerate(rules)]
    writer = staged.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts).write.mode(mode)
    (writer if partition_col is None else writer.partitionBy(PARTITION_COLUMN)).parquet(path)
    found = seen.get
    failing = [found.get(f"_c{i}") or 0 for i in range(len(rules))]
    spark = df.sparkSession
    report = spark.createDataFrame([(table, r.name, r.column, n, n == 0) for r, n in zip(rules, failing)], REPORT)
    if unique:
        columns = [f for f in df.schema if f.name in unique]
        written = spark.read.schema(type(df.schema)(columns)).parquet(path)
        again = repeated_values(written, list(unique)).select(F.lit(table).alias("table_name"), "*", (F.col("failing") == 0).alias("passed"))
        report = report.unionByName(again)
    return report


def publish_checked(
    spark: SparkSession, df: DataFrame, name: str, root: str, rules: list[Rule], unique: list[str] = (), tolerated: dict[tuple[str, str], int] | None = None
) -> tuple[DataFrame, bool]:
    """(report, published): a new version of a catalog table that takes effect only if its checks hold.

    The version is written and checked in its own folder. ``tolerated`` allows failing rows by (check, column). If a check
    fails beyond that, the catalog entry keeps its old version, or stays absent; the rejected files remain for a look.
    """
    version = f"{root}/{name.replace('.', '/')}/{uuid.uuid4().hex[:12]}"
    report = write_checked(df, version, name, rules, unique)
    allowed = tolerated or {}
    # One row per check.
    lines = report.collect()
    passed = all(r.failing <= allowed.get((r.check_name, r.column_name), 0) for r in lines)
    if passed:
        point_table(spark, name, version)
    return spark.createDataFrame(lines, REPORT), passed
