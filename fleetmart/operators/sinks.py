"""Table layout and writers: partitioned and clustered files, write modes, staging, partition-scoped merges."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators.dedup import latest_per_key
from fleetmart.operators.merge import evolve_schema, merge_append_only, merge_if_newer, merge_overwrite
from fleetmart.session import freed_shuffles, run_dir

# Write dispositions by name.
DISPOSITIONS = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append", "WRITE_EMPTY": "errorifexists"}
PARTITION_COLUMN = "_partition_date"


def _path_object(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path_object(spark, path)
    return fs.exists(hadoop)


def remove_path(spark: SparkSession, path: str) -> None:
    hadoop, fs = _path_object(spark, path)
    fs.delete(hadoop, True)


def partition_value(column: str, grain: str) -> Column:
    """First day of the DAY, MONTH or YEAR a time column falls in."""
    return F.to_date(F.date_trunc(grain.lower(), column))


def clustered(df: DataFrame, partition: str, cluster_cols: list[str]) -> DataFrame:
    """Rows gathered by partition and ordered by the cluster columns inside each task.

    REBALANCE lets AQE split a partition value that holds much of the data and join small ones, so neither one huge task
    nor many tiny files arise. The order gives narrow min/max ranges per row group.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster_cols)


def write_partitioned(
    df: DataFrame, path: str, partition_col: str, grain: str = "MONTH", cluster_cols: list[str] = (), mode: str = "overwrite",
    max_records_per_file: int | None = None,
) -> None:
    staged = clustered(df.withColumn(PARTITION_COLUMN, partition_value(partition_col, grain)), PARTITION_COLUMN, list(cluster_cols))
    writer = staged.write.mode(mode).partitionBy(PARTITION_COLUMN)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Table content without the layout column; columns that only some files have are NULL elsewhere."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(PARTITION_COLUMN)


def write_mode(df: DataFrame, path: str, disposition: str) -> None:
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {sorted(DISPOSITIONS)}")
    df.write.mode(DISPOSITIONS[disposition]).parquet(path)


def split_destination(destination: str) -> tuple[str | None, str, str]:
    """(catalog, database, table) of ``[catalog.]database.table``."""
    parts = destination.split(".")
    if len(parts) == 3:
        return parts[0], parts[1], parts[2]
    if len(parts) == 2:
        return None, parts[0], parts[1]
    raise ValueError(f"destination must be [catalog.]database.table, got {destination}")


def write_query_result(
    spark: SparkSession, statements: str | list[str], destination: str, location: str, disposition: str = "WRITE_TRUNCATE",
    partition_by: list[str] = (),
) -> DataFrame:
    """Run the statements in order and store the last result under a catalog name, files at ``location``."""
    catalog, database, table = split_destination(destination)
    last = None
    for statement in [statements] if isinstance(statements, str) else statements:
        last = spark.sql(statement)
    prefix = f"{catalog}." if catalog else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{database} LOCATION '{location}/_db'")
    name = f"{prefix}{database}.{table}"
    last.write.mode(DISPOSITIONS[disposition]).format("parquet").option("path", f"{location}/{table}").partitionBy(*partition_by).saveAsTable(name)
    return spark.table(name)


def append_day_ingest_partition(df: DataFrame, path: str, day: Column | None = None) -> None:
    """Append under the ingestion day."""
    stamp = F.current_date() if day is None else day
    df.withColumn("_ingest_date", stamp).write.mode("append").partitionBy("_ingest_date").parquet(path)


def partition_overwrite(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions present in ``df``; the others stay."""
    clustered(df, partition, []).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


@contextmanager
def staging_table(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for one run, removed also when the work on it fails."""
    path = run_dir(spark, f"staging-{name}")
    try:
        yield path
    finally:
        remove_path(spark, path)


def materialize_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def point_table(spark: SparkSession, name: str, version: str) -> None:
    """Lets a catalog name stand for the files of a version."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=version, source="parquet")


def materialize_table(spark: SparkSession, df: DataFrame, name: str, root: str) -> DataFrame:
    """Full rebuild: a new version is written first, then the catalog entry is pointed at it.

    Readers of the old version keep their files; a failed build leaves the entry as it was.
    """
    version = f"{root}/{name.replace('.', '/')}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(version)
    point_table(spark, name, version)
    return spark.table(name)


#: A merge is cut into so many slices at most, each of so many bytes of files read at least.
SLICES = 8
SLICE_BYTES = 32 * 1024 * 1024
UNKNOWN_BYTES = 2**62


def slice_count(*inputs: DataFrame) -> int:
    """Slices in which a rewrite of these rows is done one after another, so that its shuffles take a part of the disk.

    Each slice reads the inputs anew. That gives the same rows only if nothing in the plan is random, picks some rows or
    tells the time; otherwise, and where little is read, there is one slice. Rows that come from no file count as few.
    """
    read = 0
    for df in inputs:
        plan = df._jdf.queryExecution().analyzed()
        patterns = df.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
        if not plan.deterministic() or any(plan.containsPattern(p) for p in (patterns.LIMIT(), patterns.OFFSET(), patterns.CURRENT_LIKE())):
            return 1
        leaves = plan.collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length())]
        read += sum(x for x in sizes if x < UNKNOWN_BYTES)
    return max(1, min(SLICES, -(-read // SLICE_BYTES)))


def key_slices(keys: list[str], *inputs: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """The inputs by hash of the key, so that all rows of a key, in all inputs, are in one slice."""
    n = slice_count(*inputs)
    for i in range(n):
        yield tuple(df if n == 1 else df.filter(F.pmod(F.xxhash64(*keys), F.lit(n)) == i) for df in inputs)


def _partition_groups(rows: dict, n: int) -> list[list]:
    """Partition values in at most ``n`` groups of about as many rows."""
    groups, share, seen = [[] for _ in range(n)], -(-sum(rows.values()) // n), 0
    for value, count in sorted(rows.items(), key=lambda x: (x[0] is not None, x[0])):
        groups[min(n - 1, seen // share)].append(value)
        seen += count
    return [g for g in groups if g]


def _in_partitions(values: list) -> Column:
    inside = F.col(PARTITION_COLUMN).isin([v for v in values if v is not None])
    return inside | F.col(PARTITION_COLUMN).isNull() if None in values else inside


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Readers pass over names that begin with an underscore.
JOURNAL = "_merge_journal"
_READY = "_ready"


def finish_merge(spark: SparkSession, path: str) -> bool:
    """Puts a replacement that broke off into effect from its journal; True if there was one.

    A journal without its ready mark belongs to a merge that has replaced nothing yet and is dropped. Doing this twice
    gives the same table, so it may break off itself.
    """
    journal = f"{path}/{JOURNAL}"
    if not path_exists(spark, journal):
        return False
    if not path_exists(spark, f"{journal}/{_READY}"):
        remove_path(spark, journal)
        return False
    staged = spark.read.parquet(f"{journal}/rows")
    touched = [r[0] for r in spark.read.parquet(f"{journal}/touched").toLocalIterator()]
    filled = {r[0]: r[1] for r in staged.groupBy(PARTITION_COLUMN).count().toLocalIterator()}
    groups = _partition_groups(filled, slice_count(staged)) if filled else [[]]
    with freed_shuffles(spark):
        for group in groups:
            partition_overwrite(staged.filter(_in_partitions(group)) if len(groups) > 1 else staged, path, PARTITION_COLUMN)
    for day in touched:
        if day not in filled:
            remove_path(spark, f"{path}/{PARTITION_COLUMN}={NULL_PARTITION if day is None else day}")
    remove_path(spark, journal)
    return True


def _first_load(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], order_cols: list[str], partition_col: str, grain: str, cluster_cols: list[str]
) -> None:
    """The table's first rows; several slices become the table only when all of them are written."""
    with freed_shuffles(spark):
        if slice_count(source) == 1:
            write_partitioned(latest_per_key(source, keys, order_cols), path, partition_col, grain, cluster_cols)
            return
        loading = f"{path}-loading-{uuid.uuid4().hex[:12]}"
        try:
            for (rows,) in key_slices(keys, source):
                write_partitioned(latest_per_key(rows, keys, order_cols), loading, partition_col, grain, cluster_cols, "append")
            made, fs = _path_object(spark, loading)
            if not fs.rename(made, _path_object(spark, path)[0]):
                raise RuntimeError(f"{loading} could not be renamed to {path}")
        finally:
            remove_path(spark, loading)


def merge_table(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], order_cols: list[str], partition_col: str,
    grain: str = "DAY", mode: str = "if_newer", cluster_cols: list[str] = (), partition_fixed: bool = False,
) -> None:
    """Upsert into a partitioned table on files, reading and rewriting only the partitions it touches.

    Touched are the partitions source rows fall in and those their keys are stored in now, so a row whose partition
    column changed leaves its old place; the NULL partition is one of them. With ``partition_fixed`` a key never changes
    its partition, and the keys of other partitions are not read. The merged partitions and their list are first written
    to a journal inside the table's folder and marked ready; only then is anything replaced, and the journal goes last.
    A replacement that breaks off is completed from the journal by ``finish_merge``, which every merge calls first.
    Where much is read, all this is done in slices by key, and the replacement by groups of partitions.
    ``mode``: if_newer, overwrite, append_only.
    """
    if not path_exists(spark, path):
        _first_load(spark, path, source, keys, order_cols, partition_col, grain, cluster_cols)
        return
    finish_merge(spark, path)
    with staging_table(spark, "source") as source_path:
        with freed_shuffles(spark):
            for (rows,) in key_slices(keys, source):
                placed = latest_per_key(rows, keys, order_cols).withColumn(PARTITION_COLUMN, partition_value(partition_col, grain))
                placed.write.mode("append").parquet(source_path)
        fresh = spark.read.schema(placed.schema).parquet(source_path)
        stored = spark.read.option("mergeSchema", True).parquet(path)
        # A folder that holds the NULL partition alone says nothing about the type.
        target, _ = evolve_schema(stored.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("date")), fresh)
        if mode == "append_only":
            added = merge_append_only(target, fresh, keys)
            clustered(added, PARTITION_COLUMN, list(cluster_cols)).write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)
            return
        places = fresh.select(PARTITION_COLUMN)
        if not partition_fixed:
            places = places.union(target.join(fresh.select(*keys), keys, "left_semi").select(PARTITION_COLUMN))
        journal = f"{path}/{JOURNAL}"
        # One value per table partition, such as a day: bounded by the layout, not by the rows.
        with freed_shuffles(spark):
            places.distinct().coalesce(1).write.mode("overwrite").parquet(f"{journal}/touched")
        touched = [r[0] for r in spark.read.schema(places.schema).parquet(f"{journal}/touched").toLocalIterator()]
        with freed_shuffles(spark):
            for i, (scope, rows) in enumerate(key_slices(keys, target.filter(_in_partitions(touched)), fresh)):
                merged = merge_if_newer(scope, rows, keys, order_cols) if mode == "if_newer" else merge_overwrite(scope, rows, keys)
                merged.write.mode("append" if i else "overwrite").parquet(f"{journal}/rows")
        hadoop, fs = _path_object(spark, f"{journal}/{_READY}")
        fs.create(hadoop, True).close()
    finish_merge(spark, path)
