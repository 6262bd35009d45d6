import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetmart.llm import packing, pitman_yor, source_mixing, word_contexts
from fleetmart.llm.language import ContextTrees, LanguageModel, predict_language, remainder
from fleetmart.llm.packing import Packing, pack_documents
from fleetmart.llm.queries import ORACLES, QUERIES
from fleetmart.llm.words import flat, lowered
from tests.llm.test_words_graph import split

SF = "/root/testdata/sf0.001"
TINY = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TINY}/{t}.parquet'")
    return c


# language


def ppm_shares(counts, context):
    """Shares of all 256 bytes behind a context, by recursion over ever shorter ones; bytes already ruled out left aside."""
    k = len(context)
    below = [1 / 256] * 256 if k == 0 else ppm_shares(counts, context[1:])
    here = counts[k].get(context, {})
    n, q = sum(here.values()), len(here)
    if n == 0:
        return below
    left = sum(below[y] for y in range(256) if y not in here)
    if left <= 0:
        return [here.get(x, 0) / n for x in range(256)]
    return [here[x] / (n + q) if x in here else q / (n + q) * below[x] / left for x in range(256)]


def test_code_lengths_are_exact():
    training = {"xx": ["abra cadabra", "bar baz"], "yy": ["\u03b1\u03b2\u03c1\u03b1 \u3042\u3044 bar", "zaz"], "zz": [bytes(range(128)).decode() * 2]}
    languages, grams, counts = sorted(training), Counter(), {x: [defaultdict(dict) for _ in range(4)] for x in training}
    for language, texts in training.items():
        for t in texts:
            padded = b"\n\n\n" + t.encode()
            for i in range(3, len(padded)):
                grams[language, padded[i - 3] << 24 | padded[i - 2] << 16 | padded[i - 1] << 8 | padded[i]] += 1
                for k in range(4):
                    here = counts[language][k][padded[i - k : i]]
                    here[padded[i]] = here.get(padded[i], 0) + 1
    keys = sorted(grams)
    model = ContextTrees.fit(languages, np.array([languages.index(x) for x, _ in keys]), np.array([g for _, g in keys], np.int64), np.array([grams[g] for g in keys]))
    texts = ["abracadabra", "zebra!", "", "rab", "\u03b1\u03c1\u03b2 \u3046\u3044", "\x01\x02 \x05"]
    data, offsets = flat(pa.array(texts))
    got = model.code_lengths(data, offsets)
    for j, language in enumerate(languages):
        for i, t in enumerate(texts):
            padded = b"\n\n\n" + t.encode()
            want = sum(-math.log2(ppm_shares(counts[language], padded[x - 3 : x])[padded[x]]) for x in range(3, len(padded)))
            assert got[i, j] == pytest.approx(want, rel=1e-5)
    # behind every context, seen or not, the shares of all 256 bytes add up to one in every language
    for context in (b"abr", b"zeb", b"\n\n\n", b"\xce\xb1\xce", b"\x03\x04\x05", b"qqq"):
        behind = np.array([context[0] << 24 | context[1] << 16 | context[2] << 8 | x for x in range(256)], np.uint32)
        assert np.allclose(np.exp2(-model.costs(behind).astype(float)).sum(0), 1, atol=1e-4)


def test_languages_that_differ_in_rare_bytes(spark):
    """Two languages of one script with the same words but for letters whose last bytes are seldom used: far more than 64 bytes occur."""
    rng = random.Random(8)
    marks = {"one": [chr(0x4E00 + 64 * i + j) for i in range(30) for j in range(0, 20)], "two": [chr(0x4E00 + 64 * i + j) for i in range(30) for j in range(30, 50)]}
    common, rows = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(6)) for _ in range(40)], []
    for language, letters in marks.items():
        for k in range(90):
            words = rng.sample(common, 20) + rng.sample(letters, 6)
            rng.shuffle(words)
            rows.append((k, " ".join(words), language, k % 3 != 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean")
    got = predict_language(df, ["lang", "train"], F.col("train")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got if not r["train"]) >= 57


def test_languages_of_held_out_documents(spark, con):
    rows = {r["doc_id"]: r for r in QUERIES["op3_language_ppm"](spark, TINY).collect()}
    truth = dict(con.execute("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL").fetchall())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for d, r in rows.items())
    held = [d for d in truth if rows[d]["held_out"]]
    assert sum(rows[d]["lang_pred"] == truth[d] for d in held) / len(held) > 0.98


def test_language_of_odd_rows(documents):
    rows = [(1, "the cat and the dog", "en", "s"), (2, "le chat et le chien", "fr", "s"), (3, None, "en", None), (4, "", None, "s"), (5, "12 34 !!", "en", "s"), (6, "the " * 40000, None, None),
            (None, "et le chien", "fr", None), (6, "the " * 40000, None, None), (7, "ñ", None, None)]
    docs = documents(rows)
    got = predict_language(docs, ["doc_id", "size"], F.lit(True)).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert len(got) == len(rows) and by[1] == "en" and by[2] == "fr" and by[3] == by[4] == by[5] == "und" and by[6] == "en" and by[None] == "fr" and by[7] in ("en", "fr")
    nothing = predict_language(docs, ["doc_id"], F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert predict_language(docs.limit(0), ["doc_id"], F.lit(True)).count() == 0


# mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 500, None: 3}, {"é": 0, "z": 7}, {"x": 10}, {f"s{i}": i * i for i in range(12)}, {None: 0}])
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_equals_its_sql_and_meets_targets(spark, con):
    rows = {r["doc_id"]: r for r in QUERIES["op6_source_mixing"](spark, TINY).collect()}
    for doc_id, size, source_size, target, taken in con.execute(ORACLES["op6_source_mixing"]).fetchall():
        r = rows[doc_id]
        assert (r["size"], r["source_size"], r["taken"]) == (size, source_size, taken) and r["target"] == pytest.approx(target, rel=1e-12)
        assert taken <= 3 * size
    source = dict(con.execute("SELECT doc_id, source FROM documents").fetchall())
    taken, target = Counter(), {}
    for d, r in rows.items():
        taken[source[d]] += r["taken"]
        target[source[d]] = r["target"]
    assert sum(abs(taken[s] - target[s]) for s in target) < 0.05 * sum(target.values())


def test_mix_of_odd_rows(documents):
    docs = documents([(1, "a b c", None, "s"), (1, "a b c", None, "s"), (None, "d e", None, None), (2, None, None, "s"), (3, " \t", None, "empty"), (4, "w " * 50_000, None, "long")])
    rows = source_mixing.mix_sources(docs).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows) == [(0, 2), (1, 3), (1, 3), (2, 0), (3, 0), (4, 50_000)]
    assert [r["target"] for r in rows if r["doc_id"] == 3] == [0.0]
    mixed = source_mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(split(r["text"])) for r in mixed.collect())
    assert words == sum(r["taken"] for r in rows)
    assert source_mixing.mix_sources(docs.limit(0)).count() == 0 and source_mixing.mixed_documents(docs.limit(0)).count() == 0


def test_language_of_long_texts_is_learned_without_ids(spark):
    """A sample of 10 bytes draws none of these texts by its share; the least hash of each language is taken all the same."""
    texts = [("x", "aab " * 500), ("y", "ccd " * 500), ("z", "eef " * 500)]
    for with_id in (True, False):
        rows = [(i if with_id else None, t, l, True) for i, (l, t) in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean")
        got = predict_language(df, ["lang"], F.col("train"), params=LanguageModel(bytes_per_language=10)).collect()
        assert sorted((r["lang"], r["lang_pred"]) for r in got) == [("x", "x"), ("y", "y"), ("z", "z")]


# packing


def brute_pack(items, slots, capacity):
    """Every bin looked at for every item."""
    bins = []
    out = []
    for size, source, cluster in items:
        fits = [
            (capacity - sum(s for s, _, _ in b), k) for k, b in enumerate(bins)
            if sum(s for s, _, _ in b) + size <= capacity and sum(o == source for _, o, _ in b) < slots[source] and (cluster < 0 or all(c != cluster for _, _, c in b))
        ]
        if fits:
            k = min(fits)[1]
        else:
            bins.append([])
            k = len(bins) - 1
        bins[k].append((size, source, cluster))
        out.append(k)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_best_fit_under_conflicts(seed):
    rng = random.Random(seed)
    items = sorted(((rng.randrange(1, 51), rng.randrange(4), rng.choice([-1, -1, 0, 1, 2])) for _ in range(150)), key=lambda x: -x[0])
    slots = {0: 3, 1: 1, 2: 1, 3: 2}
    got, offsets = packing.pack_shard([i[0] for i in items], [i[1] for i in items], [i[2] for i in items], slots, 50)
    assert got == brute_pack(items, slots, 50)
    used = defaultdict(int)
    for (size, _, _), b, at in zip(items, got, offsets):
        assert at == used[b]
        used[b] += size


def test_all_documents_are_packed_whole(spark, con):
    rows = QUERIES["op4_conflict_packing"](spark, TINY).collect()
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        if r["length"]:
            bins[r["bin_id"]].append((r["bin_offset"], r["length"], r["doc_id"]))
    text = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    for d, t in text.items():
        at = 0
        for start, length in sorted(pieces[d]):
            assert start == at
            at += length
        assert at == len(split(t))
    for b in bins.values():
        at = 0
        for offset, length, _ in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048 and len({text[d] for _, _, d in b}) == len(b)


def test_packing_of_odd_rows(spark):
    rows = [(1, 5, "s", 1), (1, 5, "s", 1), (2, 0, None, 2), (3, None, None, None), (None, 3, None, None), (4, 23, "s", None), (5, 10, "t", 9)]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string, cluster long").withColumn("bin_id", F.lit("clash"))
    got = pack_documents(df, Packing(capacity=10)).collect()
    assert sorted(r["length"] for r in got if r["doc_id"] == 4) == [3, 10, 10]
    assert [(r["length"], r["bin_id"]) for r in got if r["doc_id"] in (2, 3)] == [(0, None), (0, None)]
    assert len({r["bin_id"] for r in got if r["doc_id"] == 1}) == 2 and sum(r["doc_id"] is None for r in got) == 1
    assert pack_documents(df.limit(0)).count() == 0


# language model


def test_stirling_numbers():
    d = 0.4
    s = np.exp(pitman_yor.log_stirling(d, 5))
    assert s[1, 1] == pytest.approx(1) and s[2, 1] == pytest.approx(1 - d) and s[3, 1] == pytest.approx((1 - d) * (2 - d)) and s[3, 2] == pytest.approx((1 - d) + (2 - 2 * d))


def test_tables_follow_their_conditional():
    """Two customers: the odds of two tables against one are strength times chance to 1 - discount."""
    n, d, theta, p = 40_000, 0.5, 2.0, 0.3
    rng = np.random.default_rng(1)
    t = pitman_yor.sample_tables(np.full(n, 2), np.full(n, theta), d, pitman_yor.log_stirling(d, 10), lambda rows, i: np.full((len(rows), len(i)), p), rng.random(n), rng.random(n))
    two = (theta + d) * p
    assert (t == 2).mean() == pytest.approx(two / (two + 1 - d), abs=0.01)
    many = pitman_yor.sample_tables(np.full(2000, 5000), np.full(2000, 50.0), d, pitman_yor.log_stirling(d, 10), lambda rows, i: np.full((len(rows), len(i)), p), rng.random(2000), rng.random(2000))
    # the chances 15 / (15 + customers - discount * tables) add up to about 15 * log
    assert 60 < many.mean() < 120 and (many <= 5000).all()


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in QUERIES["op5_pitman_yor"](spark, TINY).collect()}


def test_base_scores_equal_brute_force(scored, con):
    tokens = {d: split(t, True) + [None] for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    counts = Counter(w for d, t in tokens.items() if not held[d] for w in t)
    n, v = sum(counts.values()), len(counts)
    for d, t in tokens.items():
        r = scored[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(t), sum(w in counts for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)


def test_model_beats_the_base_on_held_out_texts(scored):
    held = [r for r in scored.values() if r["held_out"]]
    assert all(r["score"] < 0 for r in held)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up_to_one(spark):
    texts = ["a b a c", "a b", "", "b b b a c d", "a a"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = pitman_yor.fit(df, pitman_yor.Workspace(spark, "t"), pitman_yor.PitmanYor(context_part=6))
    rows = model.words.collect()
    back = model.totals.back_off()
    for u in range(len(back)):
        total = back[u] * model.totals.parent(0.0, 0.0)
        for r in rows:
            own = sum((s["n"] - model.totals.discount * s["t"]) / (model.totals.strength + model.totals.customers[u]) for s in r["seats"] if s["ctx"] == u)
            total += own + back[u] * model.totals.parent(r["above"], r["tops"])
        assert total == pytest.approx(1)


def test_rare_words_have_their_own_context(spark, documents):
    """A flat corpus: no word makes up one in 200 of the tokens, and every word foretells the next one."""
    rng = random.Random(4)
    texts = [" ".join(f"w{(i + k) % 400}" for k in range(40)) for i in (rng.randrange(400) for _ in range(300))]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    held = [r for r in pitman_yor.score_documents(docs, F.col("doc_id") % 7 == 2).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -0.6
    assert sum(r["base_score"] for r in held) / sum(r["n_tokens"] for r in held) < -2


def test_all_contexts_add_up_to_one(spark, monkeypatch):
    monkeypatch.setattr(word_contexts, "PIECE", 2)
    texts = ["a b a c", "a b", "", "b b b a c d", "a a", "c a d a", "d b c b"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = word_contexts.fit(df, pitman_yor.Workspace(spark, "t"))
    words = {r["w"]: r for r in model.words.collect()}
    pairs = {r["key"]: r["v"] for r in model.pairs.collect()}
    keys = np.array(list(words), np.int64).view(np.uint64)
    used = 0
    for u, row in words.items():
        mine = word_contexts.pair_keys(keys, np.full(len(keys), u, np.int64).view(np.uint64)).view(np.int64).tolist()
        used += sum(k in pairs for k in mine)
        own = sum(pairs.get(k, 0.0) for k in mine) / (model.parent.strength + row["c"])
        assert own + row["back"] * (model.parent.chance(0.0, 0.0) + sum(r["p"] for r in words.values())) == pytest.approx(1)
    assert used == len(pairs) == len({(a, b) for t in texts for a, b in zip([None, *t.split()], [*t.split(), None])})


def test_scores_of_odd_rows(documents):
    docs = documents([(1, "A b", None, None), (1, "A b", None, None), (None, "b c", None, None), (2, None, None, None), (3, "", None, None), (4, "a " * 60_000, None, None)])
    got = pitman_yor.score_documents(docs, remainder("doc_id", 7) == 2).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 3), (1, 3), (1, 3), (2, 1), (3, 1), (4, 60_001)]
    nothing = pitman_yor.score_documents(docs, F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] <= 0 for r in nothing)
    assert pitman_yor.score_documents(docs.limit(0), F.lit(False)).count() == 0


def test_equal_rows_are_packed_fast_and_apart(spark):
    import time

    from fleetmart.llm.packing import Packing, pack_documents, pack_shard

    began = time.time()
    bins, _ = pack_shard([10] * 20_000, [0] * 20_000, [0] * 20_000, {0: 4}, 2048)
    assert len(set(bins)) == 20_000 and time.time() - began < 5
    rows = spark.createDataFrame([(7, 10, "s", 1)] * 3000 + [(k, 100, "s", None) for k in range(50)], "doc_id long, size long, source string, cluster long")
    got = pack_documents(rows, Packing(capacity=2048, shard_docs=500)).collect()
    held = [r.bin_id for r in got if r.doc_id == 7 and r.length == 10]
    assert len(got) == 3050 and len(held) == len(set(held)) == 3000
