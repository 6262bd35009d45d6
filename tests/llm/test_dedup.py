import hashlib
import random

import pytest

from fleetmart.llm.minmax_dedup import MinMaxDedup, near_duplicates
from fleetmart.llm.substring_dedup import remove_repeats
from tests.llm.test_words_graph import split


def sets(rows, k):
    out = {}
    for d, text in rows:
        w = split(text, True)
        out[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute_components(rows, k, percent):
    s = sets(rows, k)
    parent = {d: d for d in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(s[a] & s[b])
            if both and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s[d]), find(d)) for d in ids}


@pytest.fixture(scope="module")
def corpus():
    """Families of near copies with few to many edits, exact copies, short and odd texts."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def add(text):
        rows.append((len(rows), text))

    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(120)] = rng.choice(vocabulary)
            add(" ".join(words))
    add("Copy of One TEXT that is long enough to count")
    add("copy of one text  that is long\nenough to count")
    for text in (None, "", " \n\t", "one", "One", "two words", "three short words", "x" * 3000, "repeat " * 300):
        add(text)
    for _ in range(40):
        add(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 80))))
    return rows


@pytest.mark.parametrize("params", [MinMaxDedup(shingle_words=4), MinMaxDedup(shingle_words=4, listed=3, block=7), MinMaxDedup()])
def test_near_duplicates_equal_brute_force(corpus, documents, params):
    docs = documents([(d, t, "en", "s") for d, t in corpus])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, params=params).collect()}
    assert got == brute_components(corpus, params.shingle_words, params.percent)


def test_near_duplicates_of_odd_rows(documents):
    text = "a b c d e f g h"
    docs = documents([(5, text, None, None), (5, text, None, None), (None, text, None, None), (3, text, None, None), (4, None, None, None)])
    rows = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(5, 4, 3, False), (5, 4, 3, False), (None, 4, None, True), (3, 4, 3, True), (4, 0, 4, True)], key=str)
    assert near_duplicates(docs.limit(0)).count() == 0


def brute_repeats(rows, length):
    seen, out = {}, {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        w = split(text)
        spans = [tuple(w[i : i + length]) for i in range(len(w) - length + 1)]
        gone = [False] * len(w)
        for i, s in enumerate(spans):
            if seen.setdefault(s, d) < d:
                gone[i : i + length] = [True] * length
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(60)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [make(n) for n in (8, 9, 11, 20, 35)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += make(rng.randrange(0, 15))
            words += rng.choice(shared)[: rng.randrange(6, 40)]
        rows.append((d, "  ".join(words) + rng.choice(["", "\n", " "])))
    loop = "p q r s t " * 12
    rows += [(60, loop), (61, "start " + loop + loop), (62, "p q r s t p q r s t end"), (63, None), (64, ""), (65, rows[3][1]), (66, "Z " * 30), (67, "z " * 30)]
    return rows


@pytest.mark.parametrize("length", [4, 8, 9, 10])
def test_repeats_equal_brute_force(passages, documents, length):
    docs = documents([(d, t, None, None) for d, t in passages]).repartition(3)
    want = brute_repeats(passages, length)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeats(docs, length).collect()}
    assert got == want
    laid = {r["doc_id"]: r["kept_text"] for r in remove_repeats(docs, length, layout=True).collect()}
    assert {d: " ".join(split(t)) for d, t in laid.items()} == {d: w[2] for d, w in want.items()}
    assert all(laid[d] == (t or "") for d, t in passages if want[d][1] == 0)


def test_repeats_of_odd_rows(documents):
    text = " ".join(map(str, range(60)))
    docs = documents([(2, text, None, None), (1, text, None, None), (1, text, None, None), (None, text, None, None), (3, text + " é", None, None)])
    got = sorted(((r["doc_id"], r["n_removed"], hashlib.md5(r["kept_text"].encode()).hexdigest()[:4]) for r in remove_repeats(docs, 50).collect()), key=str)
    assert sorted((d, n) for d, n, _ in got if d is not None) == [(1, 0), (1, 0), (2, 60), (3, 60)]
    assert [n for d, n, _ in got if d is None] == [0]
    assert remove_repeats(docs.limit(0), 50).count() == 0


def test_ids_with_several_texts_are_judged_row_by_row(spark, documents):
    shared = " ".join(f"s{k}" for k in range(12))
    rows = [(1, "a b " + shared, "en", "x"), (2, shared + " one more", "en", "x"), (2, "c", "en", "x"), (2, "d " + shared, "en", "x"), (2, "d " + shared, "en", "x"), (3, None, "en", "x"), (None, shared, "en", "x")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(documents(rows), 10).collect())
    assert got == [("1", 14, 0, "a b " + shared), ("2", 1, 0, "c"), ("2", 13, 12, "d"), ("2", 13, 12, "d"), ("2", 14, 12, "one more"), ("3", 0, 0, ""), ("None", 12, 0, shared)]
