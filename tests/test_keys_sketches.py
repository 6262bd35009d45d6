import pytest
from pyspark.sql import functions as F

from fleetmart.operators import keymap, sketches
from fleetmart.plans import marts
from fleetmart.session import run_dir


def test_keys_are_dense_stable_and_survive_a_broken_load(spark, monkeypatch):
    path = run_dir(spark, "keys")
    make = lambda names: spark.createDataFrame([(n,) for n in names], "id string")
    first = {r.natural_key: r.dense_key for r in keymap.extend_key_map(spark, path, make(["b", "a", None, "b", "é", "c"]), "id", 2).collect()}
    assert first == {"a": 1, "b": 2, "c": 3, "é": 4}
    # A load that broke off has rows but no success mark.
    spark.createDataFrame([("x", 99, 2)], keymap.SCHEMA).write.parquet(f"{path}/load=2")
    keymap.remove_path(spark, f"{path}/load=2/_SUCCESS")
    assert keymap.key_map(spark, path).count() == 4
    second = {r.natural_key: r.dense_key for r in keymap.extend_key_map(spark, path, make(["a0", "c", "z", "a0", ""]), "id", 1).collect()}
    assert second == {**first, "": 5, "a0": 6, "z": 7}
    assert keymap.extend_key_map(spark, path, make([]), "id").count() == 7
    rows = keymap.with_dense_key(make(["z", "nobody", None]), keymap.key_map(spark, path), "id", "k").collect()
    assert {r.id: r.k for r in rows} == {"z": 7, "nobody": None, None: None}


def test_many_keys_in_many_ranges_are_numbered_without_a_gap(spark):
    path = run_dir(spark, "keys")
    for top in (700, 1500):
        got = keymap.extend_key_map(spark, path, spark.range(top), "id", 100)
        assert got.agg(F.min("dense_key"), F.max("dense_key"), F.count_distinct("dense_key"), F.count("*")).first() == (1, top, top, top)


def test_months_come_from_daily_sketches_alone(spark):
    rows = spark.range(30_000).select((F.col("id") % 30).alias("day"), F.concat(F.lit("c"), (F.col("id") * 7919) % 9000).alias("c"))
    daily = sketches.distinct_sketch(rows, ["day"], "c")
    got = sketches.union_distinct(daily, [(F.col("day") >= 15).alias("half")]).collect()
    exact = {r.half: r.n for r in rows.groupBy((F.col("day") >= 15).alias("half")).agg(F.count_distinct("c").alias("n")).collect()}
    assert all(abs(r.estimate - exact[r.half]) <= sketches.distinct_error() * exact[r.half] for r in got) and len(got) == 2


@pytest.mark.parametrize("counters", [16, 1024])
def test_clear_winners_equal_the_exact_ones(spark, counters):
    # A third of the rows of group 0 carry one value; group 1 has no clear winner; group 2 has NULLs and one value.
    value = F.when((F.col("id") % 3 == 0), "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 200))
    rows = spark.range(6000).select(F.lit(0).alias("g"), (F.col("id") % 7).alias("day"), value.alias("v"))
    rows = rows.union(spark.range(400).select(F.lit(1), F.lit(0).cast("long"), F.concat(F.lit("w"), F.col("id") % 100)))
    rows = rows.union(spark.createDataFrame([(2, 0, "only"), (2, 1, None), (2, 1, None), (2, 3, "only"), (2, 3, "only")], "g int, d long, v string"))
    daily = sketches.top_sketch(rows, ["g", "day"], "v", counters)
    tops = sketches.clear_winner(sketches.top_values(sketches.union_top(daily, ["g"], counters), 2, counters), "v")
    got = {r.g: r.v for r in tops.collect()}
    exact = {r.g: r.v for r in marts.most_frequent(rows.where("v IS NOT NULL"), ["g"], "v").collect()}
    assert exact[0] == "hot" and got[0] == ("hot" if counters == 1024 else got[0]) and got[1] is None and got[2] in (None, "only")
    assert all(v is None or v == exact[g] for g, v in got.items())
