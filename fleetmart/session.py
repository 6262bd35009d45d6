"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


HUGE_METHOD_BYTES = "8000"
STATE_PARTITIONS_PER_CORE = 3


def build_session(app_name: str = "fleetmart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and skew handling on. Sizes stay with the cluster's own settings."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return use_session(builder.getOrCreate())


def use_session(spark: SparkSession) -> SparkSession:
    """Settings the jobs count on; both can be changed on a running session."""
    # Date and hour extraction follow UTC, whatever the host's zone is.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM never compiles methods above 8000 bytes; wide projections then run interpreted. Below this limit Spark
    # gives up the single large method and generates split code instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_BYTES)
    return spark


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[int]:
    """Streams started inside keep their state in no more partitions than keep the cores busy.

    A state partition is loaded and saved in every batch, whatever it holds. The number stays with a stream's checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    parts = max(1, min(int(before), STATE_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism))
    spark.conf.set(name, parts)
    try:
        yield parts
    finally:
        spark.conf.set(name, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside give up their shuffle files when they end, not when the driver happens to collect its garbage.

    For writes alone: an iterator over a result would lose what it still has to read.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="fleetmart-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, unique to this run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
