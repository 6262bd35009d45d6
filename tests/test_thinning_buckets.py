import datetime as dt
import random

import numpy as np

from fleetmart.session import run_dir, state_partitions
from fleetmart.streaming import throttle


def test_state_is_held_per_bucket_and_not_per_key(spark):
    rng, start, gap = random.Random(4), dt.datetime(2026, 1, 1), 300
    schema = "driver string, at timestamp, n long, maybe int"
    rows = [(None if k == 0 else f"d{k}", start + dt.timedelta(seconds=rng.randrange(8000)), i, rng.choice([None, i])) for i, k in enumerate(rng.randrange(200) for _ in range(3000))]
    rows += [(k, at, n + 3000, m) for k, at, n, m in rows[:300]]
    path, out, ck = run_dir(spark, "pings"), run_dir(spark, "kept"), run_dir(spark, "ck")
    spark.createDataFrame([], schema).write.parquet(path)
    kept = throttle.stream_ping_downsample(spark.readStream.schema(schema).parquet(path), "driver", "at", gap, "10 minutes", buckets=8)
    held = []
    for low, high in ((0, 4000), (4000, 8000)):
        part = [r for r in rows if low <= (r[1] - start).total_seconds() < high]
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        query = kept.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
        query.awaitTermination()
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    spark.createDataFrame([("beat", dt.datetime(2030, 1, 1), -1, None)], schema).write.mode("append").parquet(path)
    kept.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()
    assert max(held) <= 2 * 8
    got = sorted(r.n for r in spark.read.parquet(out).where("n >= 0").collect())
    want = sorted(r.n for r in throttle.ping_downsample(spark.createDataFrame(rows, schema), "driver", "at", gap).collect())
    assert got == want


def test_first_row_at_or_after_a_time():
    group, t = np.array([0, 0, 1, 2, 2]), np.array([5, 2**62, -(2**62), 7, 7])
    of, wanted = np.array([0, 0, 0, 1, 1, 2, 2, 3]), np.array([-9, 5, 6, -(2**62), 0, 7, 8, 0])
    assert throttle._first_at(group, t, of, wanted).tolist() == [0, 0, 1, 2, -1, 3, -1, -1]
    none = np.array([], np.int64)
    assert throttle._first_at(none, none, of, wanted).tolist() == [-1] * 8 and not len(throttle._first_at(group, t, none, none))


def test_state_partitions_follow_the_cores(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "600")
        with state_partitions(spark) as parts:
            assert parts == 3 * spark.sparkContext.defaultParallelism == int(spark.conf.get(name))
        assert spark.conf.get(name) == "600"
        spark.conf.set(name, "2")
        with state_partitions(spark) as parts:
            assert parts == 2
    finally:
        spark.conf.set(name, before)
