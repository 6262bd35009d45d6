import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmart.llm import words as W
from fleetmart.llm.graph import components
from fleetmart.llm.store import Workspace

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def split(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def of(texts, lower=False):
    out = []
    for i, j, h, first in W.each_slice(pa.array(texts, pa.string()), lower):
        out += [h[a:b] for a, b in zip(first[:-1], first[1:])]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBb é\t\n \x0b1", max_size=40)), max_size=12))
def test_words_are_those_of_the_expression(texts):
    known = {}
    for text, h in zip(texts, of(texts, True)):
        expected = split(text, True)
        assert len(h) == len(expected)
        for word, value in zip(expected, h):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_slices_do_not_change_words(monkeypatch):
    texts = ["one two", "", None, "three" * 900, "  four\nfive  ", "x"]
    whole = of(texts)
    monkeypatch.setattr(W, "SLICE_BYTES", 5)
    sliced = []
    data, offsets = W.flat(pa.array(texts))
    for i, j in W.slices(offsets, 5):
        part = data[offsets[i] : offsets[j]]
        s, e, first = W.spans(part, offsets[i : j + 1] - offsets[i])
        h = W.fingerprints(part, s, e)
        sliced += [h[a:b] for a, b in zip(first[:-1], first[1:])]
    assert all((a == b).all() for a, b in zip(whole, sliced)) and len(whole) == len(sliced) == 6


def test_flat_reads_views_of_larger_columns():
    column = pa.array(["aa", "b c", None, "d"]).slice(1, 3)
    data, offsets = W.flat(column)
    assert bytes(data) == b"b cd" and offsets.tolist() == [0, 3, 3, 4]
    assert W.flat(pa.array([], pa.string()))[1].tolist() == [0]


def test_windows_name_word_runs():
    h = of(["a b c a b c d a b"])[0]
    w = W.windows(h, 2)
    names = ["ab", "bc", "ca", "ab", "bc", "cd", "da", "ab"]
    assert all((w[i] == w[j]) == (names[i] == names[j]) for i in range(8) for j in range(8))
    assert len(W.windows(h, 10)) == 0


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(60)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links + [(None, 5)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(df, Workspace(spark, "t")).collect()}
    linked = {x for a, b in links for x in (a, b) if a != b}
    assert got == {x: find(x) for x in linked}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


@pytest.mark.parametrize("length", [0, 1, 8, 9, 5000])
def test_long_words(length):
    h = of(["x" * length + " y", "x" * length + "y"])
    assert [len(a) for a in h] == [1 + (length > 0), 1]
