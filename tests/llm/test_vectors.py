import math

import numpy as np
import pytest
from pyspark.sql import Row

from fleetmart.llm import multi_index, polytope_dedup
from fleetmart.llm.multi_index import MultiIndex, nearest_vectors
from fleetmart.llm.polytope_dedup import PolytopeDedup, near_vectors


def table(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, members string, rep long, rank int, _n int"
    return spark.createDataFrame([Row(i, None if v is None else [None if x is None else float(x) for x in v], l, "m", 1, 2, 3) for i, v, l in rows], schema)


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = (np.asarray(x, np.float32).astype(float) for x in (a, b))
    return (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = []
    for family in range(8):
        base = rng.standard_normal(16)
        for _ in range(20):
            rows.append((len(rows), list(base + rng.standard_normal(16) * 0.09 * rng.random()), family % 3))
    for _ in range(60):
        rows.append((len(rows), list(rng.standard_normal(16)), int(rng.integers(3))))
    rows += [(500 + k, rows[5][1], rows[5][2]) for k in range(30)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [None] + [1.0] * 15, 1), (603, [float("nan")] + [1.0] * 15, 1), (604, [float("inf")] + [1.0] * 15, 1), (605, [], 1)]
    rows += [(700, rows[0][1], None), (701, rows[0][1][:8], rows[0][2]), (702, [2 * x for x in rows[0][1]], rows[0][2])]
    return rows


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).standard_normal((5, 8))
    y = polytope_dedup.hadamard(x)
    assert np.allclose((x * x).sum(1), (y * y).sum(1)) and np.allclose(polytope_dedup.hadamard(y), x)


@pytest.mark.parametrize("params", [PolytopeDedup(tables=24), PolytopeDedup(tables=24, listed=2, block=5), PolytopeDedup(tables=24, hashes=2, listed=9, block=5)])
def test_links_equal_brute_force(spark, vectors, params):
    links, parent = {i: 0 for i, _, _ in vectors}, {i: i for i, _, _ in vectors}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, v, l) in enumerate(vectors):
        for j, w, m in vectors[:a]:
            if l is not None and l == m and good(v) and good(w) and len(v) == len(w) and cosine(v, w) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    got = {r["vec_id"]: r for r in near_vectors(table(spark, vectors), params=params).collect()}
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (links[i], find(i), find(i) == i) for i in links}
    assert sum(links.values()) > 1000


def test_links_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(7, v, 1), (7, v, 1), (None, v, 1), (3, v, 2)]
    got = sorted((tuple(r) for r in near_vectors(table(spark, rows)).collect()), key=str)
    assert got == sorted([(7, 1, 7, True), (7, 1, 7, True), (None, 0, None, True), (3, 0, 3, True)], key=str)
    assert near_vectors(table(spark, [])).count() == 0


def test_cells_come_in_the_order_of_summed_distance():
    rng = np.random.default_rng(2)
    a, b, sizes = rng.random(7), rng.random(5), rng.integers(0, 4, 35)
    full = multi_index.visit(a, b, sizes, 10**9)
    total = (a[:, None] + b[None, :]).ravel()
    assert full == [c for c in np.argsort(total, kind="stable") if sizes[c]]
    some = multi_index.visit(a, b, sizes, 6)
    assert some == full[: len(some)] and sizes[some].sum() >= 6 > sizes[some[:-1]].sum()


def brute_nearest(rows, query, k):
    own = next(v for i, v, _ in rows if i == query)
    near = sorted((-round(cosine(own, v), 12), i) for i, v, _ in {i: (i, v, l) for i, v, l in rows}.values() if i != query and good(v) and len(v) == len(own))
    return near[:k]


def test_all_cells_give_the_exact_neighbours(spark, vectors):
    df = table(spark, vectors)
    got = nearest_vectors(df, df.where("vec_id % 20 = 0"), params=MultiIndex(share=1.0)).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((-round(r["score"], 12), r["vec_id"]))
    wanted = [i for i, v, _ in vectors if i % 20 == 0 and good(v)]
    assert sorted(found) == wanted and all(found[q] == brute_nearest(vectors, q, 5) for q in wanted)


def test_recall(spark):
    rng = np.random.default_rng(6)
    rows = [(i, list(v), 0) for i, v in enumerate(rng.standard_normal((4000, 32)))]
    df = table(spark, rows)
    got = nearest_vectors(df, df.where("vec_id % 50 = 0"), params=MultiIndex(least=100)).collect()
    x = np.array([v for _, v, _ in rows])
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    hits = 0
    for q in range(0, 4000, 50):
        c = x @ x[q]
        c[q] = -2
        hits += len(set(np.argsort(-c)[:5]) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits / 400 >= 0.9


def test_neighbours_of_odd_rows(spark):
    df = table(spark, [(0, [1, 0], 1), (1, [1, 0], 1), (1, [1, 0], 1), (2, [0, 1], None), (None, [1, 1], 1), (50, None, 1), (100, [1, 2, 3], 1)])
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest_vectors(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert nearest_vectors(df.limit(0), df).count() == 0


def test_registered_parameters_find_all_links(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 64))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    y = rng.standard_normal((600, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.sqrt((y * y).sum(1, keepdims=True))
    near = rng.uniform(0.9805, 0.99, (600, 1))
    both = np.concatenate((x, near * x + np.sqrt(1 - near**2) * y)).astype(np.float32).astype(float)
    unit = both / np.sqrt((both * both).sum(1, keepdims=True))
    links = (unit @ unit.T >= 0.98).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(table(spark, [(i, list(v), 1) for i, v in enumerate(both)]), params=PolytopeDedup()).collect()}
    assert links.sum() >= 1200 and got == dict(enumerate(links.tolist()))


def test_recall_of_registered_parameters(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 64))
    df = table(spark, [(i, list(v), 0) for i, v in enumerate(x)])
    got = {}
    for r in nearest_vectors(df, df.where("vec_id % 100 = 0"), params=MultiIndex(neighbours=5)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    hits = 0
    for q in range(0, 6000, 100):
        c = x @ x[q]
        c[q] = -2
        hits += len(set(np.argsort(-c)[:5].tolist()) & got[q])
    assert hits / 300 >= 0.9


def test_vectors_of_any_size_are_compared_by_angle(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [1.0, 0.0]), (5, [1e-200, -1e-200]), (6, [5e-324, 5e-324]), (7, [1e308, 1.0]), (8, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 6: (3, 1), 4: (1, 4), 7: (1, 4), 5: (0, 5), 8: (0, 8)}
    near = nearest_vectors(df, df.where("vec_id = 1"), params=MultiIndex(neighbours=3)).collect()
    assert [(r.rank, r.vec_id) for r in sorted(near, key=lambda r: r.rank)] == [(1, 2), (2, 3), (3, 6)] and all(abs(r.score - 1) < 1e-12 for r in near)
