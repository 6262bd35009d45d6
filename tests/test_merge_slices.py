import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import sinks
from fleetmart.session import freed_shuffles, run_dir

SCHEMA = "id string, v int, day date, note string"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "v", "day", "note").collect()), key=str)


def batch(spark, seed):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.1 else dt.date(2026, 1, 1 + rng.randrange(5))
    rows = [(None if k == 0 else f"k{k}", rng.randrange(4), day(), str(i)) for i, k in enumerate(rng.randrange(60) for _ in range(150))]
    path = run_dir(spark, "batch")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("mode", ["if_newer", "overwrite"])
def test_slices_give_the_table_of_one_slice(spark, monkeypatch, mode):
    batches, tables, calls = [batch(spark, s) for s in (1, 2, 3)], [], []
    real = sinks.partition_overwrite
    monkeypatch.setattr(sinks, "partition_overwrite", lambda *a: calls.append(a) or real(*a))
    for size in (sinks.SLICE_BYTES, 1):
        monkeypatch.setattr(sinks, "SLICE_BYTES", size)
        path = run_dir(spark, "t")
        for b in batches:
            sinks.merge_table(spark, path, b, ["id"], ["v"], "day", mode=mode)
        tables.append(rows_of(sinks.read_table(spark, path)))
        assert not sinks.path_exists(spark, f"{path}/{sinks.JOURNAL}")
    assert tables[0] == tables[1] and len(calls) > 4


def test_a_first_load_that_breaks_off_leaves_no_table(spark, monkeypatch):
    monkeypatch.setattr(sinks, "SLICE_BYTES", 1)
    path, source, real, done = run_dir(spark, "t"), batch(spark, 1), sinks.write_partitioned, []

    def broken(*args):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(real(*args))

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_partitioned", broken)
        with pytest.raises(RuntimeError):
            sinks.merge_table(spark, path, source, ["id"], ["v"], "day")
    assert len(done) == 2 and not sinks.path_exists(spark, path)
    sinks.merge_table(spark, path, source, ["id"], ["v"], "day")
    assert sinks.read_table(spark, path).count() == source.select("id").distinct().count()


def test_only_plans_that_repeat_themselves_are_cut(spark, monkeypatch):
    df = batch(spark, 1)
    assert sinks.slice_count(df) == 1 and sinks.slice_count(spark.createDataFrame([(1,)], "x int")) == 1
    monkeypatch.setattr(sinks, "SLICE_BYTES", 1)
    assert sinks.slice_count(df) == sinks.SLICES and sinks.slice_count(df, df) == sinks.SLICES
    for other in (df.limit(3), df.offset(3), df.withColumn("at", F.current_timestamp()), df.withColumn("u", F.expr("uuid()"))):
        assert sinks.slice_count(other.filter("v > 0")) == 1 and sinks.slice_count(df, other) == 1


def test_partition_groups_hold_every_partition_once():
    days = {dt.date(2026, 1, d): d * 10 for d in range(1, 20)} | {None: 500}
    for n in (1, 3, 8, 30):
        groups = sinks._partition_groups(days, n)
        assert len(groups) <= n and sorted(map(str, (d for g in groups for d in g))) == sorted(map(str, days))


def test_freed_shuffles_puts_the_setting_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise RuntimeError
    assert spark.conf.get(name) == before
