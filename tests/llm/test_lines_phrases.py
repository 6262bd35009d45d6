"""Repeated lines, phrases and whitening against plain versions of their definitions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Row

from fleetmart.llm import bloom, contour
from fleetmart.llm.line_dedup import LineDedup, remove_repeated_lines
from fleetmart.llm.phrase_mining import PhraseMining, mine_phrases
from fleetmart.llm.store import Workspace
from fleetmart.llm.whitening import Whitening, whiten

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows, p):
    """(doc_id, n_lines, n_dropped, kept_text) by the definition."""
    texts = [(d, (t or "").split("\n")) for d, t, *_ in rows]
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = defaultdict(list)
    for d, ls in texts:
        for k in {key(x) for x in ls}:
            if len(k) >= p.least_chars:
                holders[k].append(d)
    gone = {k for k, ds in holders.items() if len(ds) >= p.documents}
    first = {k: min((d for d in holders[k] if d is not None), default=None) for k in gone}
    out = []
    for d, ls in texts:
        kept, seen = [], set()
        for x in ls:
            k = key(x)
            if k not in gone or (p.keep_first and d == first[k] and k not in seen):
                kept.append(x)
            seen.add(k)
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LINE_ROWS = [
    (1, "Menu\nfirst text\n  MENU \t\nlast", "en", "a"),
    (2, "menu", "en", "a"),
    (3, "\n\nmenu\nÉtat\n", "fr", None),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, "x\r\nétat\n" + "long " * 50_000 + "\nx", "en", "b"),
    (7, "état\nx\r", "en", "b"),
    (7, "état\nx\r", "en", "b"),
    (7, "another\nmenu", "en", "b"),
    (None, "menu\nx", "en", "b"),
    (None, "only here\nonly here", "en", "b"),
    (8, "É\nÉ\x85\n　", "en", "b"),
    (9, "\x00\nÉ", "en", "b"),
    (10, " " * 100 + "MENU" + "\t" * 70 + "\n" + " " * 90 + "\n" + " " * 40 + "É", "en", "b"),
]


@pytest.mark.parametrize("p", [LineDedup(documents=2), LineDedup(documents=3, least_chars=2), LineDedup(documents=2, keep_first=True), LineDedup(documents=2, most_bits=1 << 16, bits_per_line=1)])
def test_lines_equal_the_definition(spark, documents, p):
    got = remove_repeated_lines(documents(LINE_ROWS), p).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_lines(LINE_ROWS, p)


def test_many_lines_over_full_filters_and_partitions(spark, documents):
    r = random.Random(5)
    pool = [f"line {k} " + "y" * r.randrange(9) for k in range(4000)]
    rows = [(d, "\n".join(r.choice(pool[: 40 if d % 5 == 0 else 4000]) for _ in range(r.randrange(300))), "en", "a") for d in range(200)]
    p = LineDedup(documents=10, bits_per_line=1, most_bits=1 << 16)
    got = remove_repeated_lines(documents(rows).repartition(7), p).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain_lines(rows, p)


def test_no_documents_no_lines(spark, documents):
    assert remove_repeated_lines(documents([])).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_lines(documents([]), LineDedup(documents=1))


@pytest.mark.parametrize("bits", [1 << 16, 1 << 23])
def test_filter_knows_what_came_twice(spark, bits, monkeypatch):
    monkeypatch.setattr(bloom, "FAN", 2)
    keys = list(range(1, 3001)) + list(range(1, 3001, 3))
    df = spark.createDataFrame([(k * 7919 * 104729,) for k in keys], "k long").repartition(9)
    made = df.mapInArrow(lambda batches: bloom.gathered_parts((b.column(0).to_numpy().astype(np.uint64) for b in batches), bits), bloom.PARTS)
    for which, step in (("once", 1), ("twice", 3)):
        found = bloom.merged(made, bits, Workspace(spark, "bloom"), which)
        assert found.has(np.arange(1, 3001, step).astype(np.uint64) * np.uint64(7919 * 104729)).all()
        assert found.has(np.arange(10**6, 10**6 + 1000).astype(np.uint64) * np.uint64(7919)).mean() < 0.05


def plain_phrases(rows, p):
    counts, words = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            words[lang or "und"] += len(ws)
            for k in range(1, p.words + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang or "und", tuple(ws[i : i + k])] += 1
    longer = defaultdict(int)
    for (lang, g), a in counts.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                longer[lang, g[i : i + m]] = max(longer[lang, g[i : i + m]], a)
    out = []
    for lang in words:
        found = []
        for (of, g), a in counts.items():
            if of == lang and len(g) > 1 and a >= p.least and not 100 * longer[lang, g] >= p.percent * a:
                score, k = min((2_000_000 * a // (counts[lang, g[:k]] + counts[lang, g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
        out += [(lang, i, g.decode(), -a, l, r, words[lang], -s) for i, (s, a, g, l, r) in enumerate(sorted(found)[: p.top], 1)]
    return sorted(out)


def phrase_rows():
    r = random.Random(3)
    vocabulary = ["Über", "the", "cat", "sat", "on", "mat", "x\x00y", "'s", "ça", "a-b"]
    rows = []
    for d in range(120):
        words = [r.choice(vocabulary[: 3 + d % 8]) + r.choice(["", "", "", ",", ".", "\r\n", "!?"]) for _ in range(r.randrange(1, 90))]
        rows.append((d, r.choice([" ", "\t ", "  "]).join(words), [None, "und", "en", "de"][d % 4], "a"))
    rows += [(500, None, "en", None), (501, "", None, None), (502, " \t\n.", "zz", None), (503, "the the " * 3000, "en", None), (None, "the cat sat on", "en", "b"), (500, "the cat sat on", "en", "b")]
    return rows


@pytest.mark.parametrize("p", [
    PhraseMining(least=5, top=10_000), PhraseMining(least=5, top=7, percent=50), PhraseMining(least=3, budget=50), PhraseMining(least=2, budget=3, words=3), PhraseMining(least=4, words=2, budget=10),
    PhraseMining(least=5, words=5, budget=60, most_bits=1 << 16),
])
def test_phrases_equal_the_definition(spark, documents, p):
    rows = phrase_rows()
    got = mine_phrases(documents(rows).repartition(5), p).collect()
    assert sorted(tuple(r) for r in got) == [x for x in plain_phrases(rows, p)]


def test_no_documents_no_phrases(spark, documents):
    assert mine_phrases(documents([])).collect() == []
    assert mine_phrases(documents([(1, None, "en", None), (2, "alone", None, None)])).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame([Row(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, x string, n double")


def plain_whitening(rows, k=4):
    """{component: (n, e, vector)}, fit list."""
    x = {i: np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    centred = fit - fit.mean(0)
    values, vecs = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, values[::-1], vecs[:, ::-1]


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 1, (300, 12)) * np.linspace(2, 0.3, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(900 + i, base[i].tolist()) for i in range(40)] + [(5, base[7].tolist())]
    bad = [(1001, None), (1002, [None] * 12), (1003, [float("nan")] * 12), (1004, [float("-inf")] + [0.0] * 11)]
    rows += [(2000, [0.0] * 12), (2001, [-0.0] * 12), (None, base[3].tolist())]
    got = whiten(vectors(spark, [(i, v, 1) for i, v in rows + bad])).collect()
    x, fit, values, vecs = plain_whitening([(k, v) for k, (_, v) in enumerate(rows)])
    s, n = fit.sum(0), len(fit)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    assert {r.vec_id for r in got} == {i for i, _ in rows}
    signs = {}
    by_vector = defaultdict(list)
    for r in got:
        by_vector[r.vec_id, r.component].append(r)
    for k, (i, _) in enumerate(rows):
        for c in range(1, 5):
            want = (x[k] - s / n) @ vecs[:, c - 1] / np.sqrt(values[c - 1])
            r = min(by_vector[i, c], key=lambda r: abs(abs(r.whitened) - abs(want)))
            if abs(want) > 1e-6:
                assert signs.setdefault(c, np.sign(r.whitened * want)) == np.sign(r.whitened * want)
            assert abs(abs(r.whitened) - abs(want)) < 1e-9 and abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-9
            if len(by_vector[i, c]) == 1:
                assert r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[k], s))


def test_whitening_of_few_flat_and_huge_vectors(spark):
    assert whiten(vectors(spark, [])).collect() == []
    assert whiten(vectors(spark, [(1, None, 1), (2, [], 1), (3, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)])).collect() == []
    # Two lengths, of rank one each; entries beyond 64 bits are cut.
    got = whiten(vectors(spark, [(1, [0.0, 0.0], 1), (2, [1.0, 1.0], 1), (3, [0.0, 0.0, 1.0], 1), (4, [1e30, 0.0, 1.0], 1)]), params=Whitening(components=4)).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in got) == [(1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 1, 2)]
    assert {r.vec_id: r.deviation for r in got} == {1: 2 * 256**2, 2: 2 * 256**2, 3: None, 4: None}
    assert all(abs(abs(r.whitened) - 1) < 1e-9 and abs(r.explained - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("values", [[5.0] * 6 + [1.0] * 4, [100, 99.9999999, 50, 49.9999] + [0.1 * k for k in range(20)], [2.0**-k for k in range(30)], [3.0, 2.0, 0, 0, 0], [1.0], [14000.0, *(1090 - 0.5 * k for k in range(60))], [1.0] * 9, [9.0, 4, 4, 4, 4, 4, 1], list(1000 + np.linspace(1, 0, 40))])
def test_contour_finds_the_leading_eigenvalues(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    a = q * np.array(values) @ q.T
    a = (a + a.T) / 2
    found, vecs = contour.leading(a, 4)
    want = [v for v in sorted(values, reverse=True)[:4] if v > 0]
    assert np.allclose(found, want, rtol=0, atol=1e-12 * max(values)) and np.allclose(vecs.T @ vecs, np.eye(len(want)), atol=1e-12)
    assert np.abs(a @ vecs - vecs * found).max() < 1e-11 * max(values)


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 30):
        a = rng.standard_normal((n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (-1.5, 0.0, 0.3, 4.0):
            assert contour.above(a, shift) == (values > shift).sum()
    assert contour.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
