"""The sweep over versions and probes against the definition, and its shape for one hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetmart.operators import history
from fleetmart.operators.asof import version_at
from fleetmart.operators.sequence import placed, row_slices, with_neighbour

START = dt.datetime(2026, 1, 1)


def minute(m):
    return None if m is None else START + dt.timedelta(minutes=m)


def random_case(seed):
    rng = random.Random(seed)
    versions, probes = [], []
    for k in ["a", "b", "c", "hot"]:
        t = rng.randrange(20)
        for n in range(60 if k == "hot" else rng.randrange(1, 6)):
            end = t + rng.choice([1, 3, 7])
            versions.append((k, minute(t), None if rng.random() < 0.05 else minute(end), f"{k}{n}"))
            t = end + rng.choice([0, 0, 0, 4])
    versions += [(None, minute(0), None, "no key"), ("a", None, None, "no time")]
    for i in range(400):
        k = rng.choice(["a", "b", "c", "hot", "hot", "hot", "x", None])
        probes.append((i, k, minute(rng.choice([None, *range(-5, 260)])), "extra"))
    return versions, probes


def plain(versions, probes, first_before):
    out = {}
    for i, k, at, _ in probes:
        mine = sorted(((f, t or dt.datetime.max, n) for kk, f, t, n in versions if kk == k and k is not None and f is not None))
        began = [v for v in mine if at is not None and v[0] <= at]
        out[i] = None
        if began:
            out[i] = began[-1][2] if at < began[-1][1] else None
        elif mine and at is not None and first_before:
            out[i] = mine[0][2]
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rows", [None, 13, 100])
def test_sweep_equals_the_definition(spark, seed, rows):
    versions, probes = random_case(seed)
    v = spark.createDataFrame(versions, "id string, valid_from timestamp, valid_to timestamp, n string").repartition(3)
    p = spark.createDataFrame(probes, "i int, ref string, at timestamp, valid_to string").repartition(3)
    for first in (False, True):
        got = version_at(p, v, "ref", "id", "at", {"found": F.col("n")}, first, rows_per_slice=rows)
        assert got.columns == ["i", "ref", "at", "valid_to", "found"]
        assert {r.i: r.found for r in got.collect()} == plain(versions, probes, first)
    dropped = version_at(p, v, "ref", "id", "at", {"found": F.col("n")}, keep_unmatched=False, rows_per_slice=rows)
    assert {r.i: r.found for r in dropped.collect()} == {i: n for i, n in plain(versions, probes, False).items() if n is not None}


@pytest.mark.parametrize("rows", [None, 40])
def test_overlapping_versions_are_all_found(spark, rows):
    rng = random.Random(9)
    versions = [(rng.choice("ab"), minute(a), None if n == 7 else minute(a + rng.randrange(0, 9)), n) for n, a in enumerate(rng.randrange(100) for _ in range(30))]
    versions += [("a", minute(10), minute(90), 100), ("a", minute(10), minute(90), 101), (None, minute(0), None, 102)]
    probes = [(i, rng.choice(["a", "b", "c", None]), minute(rng.randrange(-3, 130))) for i in range(200)]
    v, p = spark.createDataFrame(versions, "id string, valid_from timestamp, valid_to timestamp, n int"), spark.createDataFrame(probes, "i int, id string, at timestamp")
    got = history.scd2_as_of_each(v, p, "id", "at", rows)
    assert got.columns == ["i", "id", "at", "valid_from", "valid_to", "n"]
    want = [(i, k, at, f, t, n) for i, k, at in probes for kk, f, t, n in versions if k is not None and k == kk and f <= at and (t is None or at < t)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_keys_of_other_types_and_empty_sides(spark):
    v = spark.createDataFrame([(1, minute(0), None, 7)], "id long, valid_from timestamp, valid_to timestamp, n int")
    p = spark.createDataFrame([("1", minute(3)), ("2", minute(3))], "ref string, at timestamp")
    found = lambda p, v: {r.ref: r.n for r in version_at(p, v, "ref", "id", "at", {"n": F.col("n")}).collect()}
    assert found(p, v) == {"1": 7, "2": None}
    assert found(p, v.limit(0)) == {"1": None, "2": None}
    assert found(p.limit(0), v) == {}


def test_one_key_with_ten_thousand_versions_and_a_million_probes(spark, plan):
    versions = spark.range(10_000).select(
        F.lit("k").alias("id"), F.timestamp_seconds(F.col("id") * 60).alias("valid_from"), F.timestamp_seconds((F.col("id") + 1) * 60).alias("valid_to"), F.col("id").alias("n")
    )
    probes = spark.range(1_000_000).select(F.lit("k").alias("ref"), F.timestamp_seconds((F.col("id") * 7919) % 600_000).alias("at"))
    joined = version_at(probes, versions, "ref", "id", "at", {"n": F.col("n")}, rows_per_slice=200_000)
    right = joined.select((F.floor(F.unix_seconds("at") / 60) == F.col("n")).alias("right"))
    # The key is cut into slices, each sorted by itself.
    held = [r["count"] for r in right.groupBy("right").count().collect()]
    assert held == [1_000_000]
    text = plan(joined).split("== Physical Plan ==")[-1]
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and all("<" not in line and ">" not in line for line in joins) and "NestedLoop" not in text


def test_cuts_place_like_a_search(spark):
    import bisect

    values = [None, -1, 0, 5, 6, 7, 999, 1000, 10**6]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for cuts in ([5], [0, 6, 7], list(range(0, 3000, 3)), [7 * k for k in range(33)]):
        got = [r[0] for r in df.select(placed(F.col("v"), cuts)).collect()]
        assert got[1:] == [bisect.bisect_right(cuts, v) for v in values[1:]]


def test_neighbours_by_row_slices_equal_plain_ones(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), minute(rng.randrange(100)), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, i int")
    want = {}
    for k in "ab":
        mine = sorted((t, i) for kk, t, i in rows if kk == k)
        want |= {i: (mine[x + 1][1] if x + 1 < len(mine) else None) for x, (_, i) in enumerate(mine)}
    for size in (None, 7, 90):
        got = with_neighbour(df, ["k"], ["ts", "i"], {"next": "i"}, row_slices(df, "ts", size)).collect()
        assert {r.i: r.next for r in got} == want


def test_versions_far_apart_are_chained(spark):
    log = spark.createDataFrame([("a", dt.datetime(1990, 1, 1), 1, "c"), ("a", dt.datetime(2026, 5, 1), 2, "u"), ("a", dt.datetime(2026, 5, 2), 3, "d")], "id string, ts timestamp, lsn int, op string")
    got = history.scd2_from_changes(log, "id").orderBy("lsn").collect()
    assert [(r.lsn, r.valid_to) for r in got] == [(1, dt.datetime(2026, 5, 1)), (2, dt.datetime(2026, 5, 2))]
