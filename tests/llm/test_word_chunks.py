"""Packed chunks of the word model: round trips, counts over chunks, and results that do not depend on the cut."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmart.llm import pitman_yor, word_chunks, word_contexts


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)))
def test_packed_numbers_come_back(values):
    x = np.array(values, np.uint64)
    assert word_chunks.unpack(word_chunks.pack(x), np.uint64).tolist() == values
    assert word_chunks.unpack_sorted(word_chunks.pack_sorted(np.sort(x))).tolist() == sorted(values)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=200), st.integers(1, 50))
def test_buckets_cut_sorted_keys_in_order(values, buckets):
    x = np.unique(np.array(values, np.uint64))
    cut = list(word_chunks.by_bucket(x, buckets))
    assert [b for b, _ in cut] == sorted({(v >> 32) * buckets >> 32 for v in x.tolist()})
    assert [v for _, at in cut for v in x[at].tolist()] == x.tolist()


def test_counts_over_chunks_equal_brute_force():
    rng = random.Random(3)
    held = [{k: rng.choice([0, 0, 1, 1, 2]) for k in rng.sample(range(60), 25)} for _ in range(6)]
    total = Counter()
    for chunk in held:
        total.update(chunk)
    rows = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], np.int64)) for c in held]
    asked = pa.table({"bucket": pa.array([0] * 6, pa.int32()), "chunk": pa.array(range(6)), "keys": [word_chunks.pack_sorted(k) for k, _ in rows], "n": [word_chunks.pack(n) for _, n in rows]})
    owners = Counter()
    for (keys, _), x in zip(rows, word_contexts._count(asked).column("told").to_pylist()):
        for k, t in zip(keys.tolist(), word_chunks.unpack(x, np.uint64).tolist()):
            if t > word_contexts.OFTEN:
                owners[k] += 1
                assert t - 1 == total[k] > 1
            else:
                assert t == min(total[k], word_contexts.OFTEN)
    assert owners == {k: 1 for k, n in total.items() if n > 1}


def test_scores_do_not_depend_on_the_chunks(spark, documents):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    one, many = (
        {r["doc_id"]: r.asDict() for r in pitman_yor.score_documents(docs.repartition(n), F.col("doc_id") % 7 == 2).collect()} for n in (1, 5)
    )
    assert one.keys() == many.keys() == set(range(60))
    for i, r in one.items():
        assert [r[x] for x in ("held_out", "n_tokens", "n_known", "train_tokens")] == [many[i][x] for x in ("held_out", "n_tokens", "n_known", "train_tokens")]
        assert r["base_score"] == pytest.approx(many[i]["base_score"]) and r["score"] == pytest.approx(many[i]["score"], rel=1e-6)


def one_chunk(monkeypatch, texts):
    monkeypatch.setattr(word_chunks, "TaskContext", type("Here", (), {"get": staticmethod(lambda: type("At", (), {"partitionId": lambda self: 0})())}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([i % 7 == 2 for i in range(len(texts))]), pa.array(texts)], ["doc_id", "held_out", "text"])
    (row,) = word_chunks.chunks(iter([batch]))
    return word_chunks.Chunk(row.to_pylist()[0])


def test_pairs_of_a_chunk_take_little_memory(monkeypatch):
    """A task's memory goes with its chunk: deriving these pairs once took 52 bytes for each token."""
    rng = random.Random(8)
    chunk = one_chunk(monkeypatch, [" ".join(str(int(min(rng.paretovariate(0.25), 1e9))) for _ in range(2000)) for _ in range(100)])
    chunk._codes
    tracemalloc.start()
    chunk.keys
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 * len(chunk.tokens)


def test_pairs_and_sums_of_a_chunk_equal_brute_force(monkeypatch):
    rng = random.Random(9)
    texts = ["", "a", *(" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30))) for _ in range(40))]
    chunk = one_chunk(monkeypatch, texts)
    seen, trained = Counter(), Counter()
    for i, text in enumerate(texts):
        words = [None, *text.split(), None]
        seen.update(zip(words, words[1:]))
        if i % 7 != 2:
            trained.update(zip(words, words[1:]))
    assert len(chunk.keys) == len(seen) and np.all(np.diff(chunk.keys.astype(object)) > 0)
    assert sorted(chunk.trained.tolist()) == sorted(trained[x] for x in seen)
    value = np.arange(len(chunk.keys), dtype=float)
    w, ctx = chunk.pairs
    place = {(a, b): v for a, b, v in zip(w.tolist(), ctx.tolist(), value)}
    end = int(np.searchsorted(chunk.words, pitman_yor.END))
    sums = []
    for i, j in zip(chunk.first[:-1], chunk.first[1:]):
        tokens = chunk.tokens[i:j].tolist()
        sums.append(sum(place[x] for x in zip(tokens, [end, *tokens[:-1]])))
    assert chunk.over_texts(value).tolist() == sums


def test_sampled_tables_do_not_depend_on_the_batches(monkeypatch):
    rng = random.Random(10)
    rows = []
    for w in range(60):
        rows.append((w, 0, None, 50, 60.0 if w % 3 else None, 4, 20.0 if w % 2 else None))
        rows += [(w, 0, c, rng.choice([2, 3, 5, 90]), 30.0, None, None) for c in rng.sample(range(99), rng.randrange(12))]
    columns = ["w", "piece", "ctx", "n", "k", "singles", "own"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64()]
    whole = pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], columns)
    parent = word_contexts.Parent(900.0, 60.0, 60, 0.6, 0.5, 1.0)

    def sampled(size, width):
        monkeypatch.setattr(word_contexts, "BATCH", size)
        batches = (whole.slice(i, size) for i in range(0, len(rows), size))
        return pa.Table.from_batches(word_contexts._gibbs(parent, pitman_yor.PitmanYor(), width)(batches))

    one = sampled(10_000, 4)
    assert one.equals(sampled(7, 4).combine_chunks()) and one.column("ctx").to_pylist() == [r[2] for r in rows]
    summed = np.sum([one.column(f"t{i}").to_numpy() for i in range(4)], 0)
    assert summed.tolist() == sampled(50, 1).column("t0").to_pylist()
    assert all(1 <= t <= r[3] for r, t in zip(rows, one.column("t3").to_pylist()) if r[2] is not None)


def test_words_of_one_token_are_not_sampled(spark, monkeypatch):
    """They have one table for certain; most words of a large corpus are such."""
    saved, save = {}, pitman_yor.Workspace.save
    monkeypatch.setattr(pitman_yor.Workspace, "save", lambda self, df, name="table", **more: saved.setdefault(name, []).append(save(self, df, name, **more)) or saved[name][-1])
    df = spark.createDataFrame([("a b a b once",), ("a b never again",)], "text string")
    model = word_contexts.fit(df, pitman_yor.Workspace(spark, "t"))
    rows = {r["w"]: r for r in model.words.collect()}
    assert sorted(r["c"] for r in rows.values()) == [1, 1, 1, 2, 3, 3]
    assert all(r["above"] == r["tops"] == [1.0] * 4 for r in rows.values() if r["c"] == 1)
    assert {r["w"] for r in saved["seated"][-1].select("w").distinct().collect()} == {w for w, r in rows.items() if r["c"] > 1}
