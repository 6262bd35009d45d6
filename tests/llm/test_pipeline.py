import random

import pytest

import corpus_pipeline
from fleetmart.llm.store import Workspace
from tests.llm.test_dedup import brute_components, brute_repeats
from tests.llm.test_words_graph import split

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first stage and after every one."""
    docs, work = spark.read.parquet(f"{TINY}/documents.parquet"), Workspace(spark, "t")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(work.save(stage(spark, out[-1], TINY), name))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(steps):
    assert all(df.columns == steps[0].columns for df in steps[:5])


def test_languages_keep_clean_documents(steps):
    assert set(rows(steps[1])) == set(rows(steps[0]))


def test_one_of_each_group_stays(steps):
    before = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    assert set(rows(steps[2])) == {d for d, (_, c) in brute_components(before, 5, 80).items() if c == d}


def test_passages_are_cut(steps):
    want = brute_repeats([(r["doc_id"], r["text"]) for r in steps[2].collect()], corpus_pipeline.PASSAGE_WORDS)
    got = rows(steps[3])
    assert {d: " ".join(split(r["text"])) for d, r in got.items()} == {d: w[2] for d, w in want.items() if w[2] or not w[1]}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_mix_and_packing_hold_the_same_words(steps):
    mixed = steps[4].collect()
    assert {r["doc_id"] for r in mixed} <= set(rows(steps[3]))
    packed = steps[5].collect()
    assert sum(r["length"] for r in packed) == sum(len(split(r["text"])) for r in mixed)
    fill = {}
    for r in packed:
        if r["length"]:
            fill.setdefault(r["bin_id"], []).append((r["doc_id"], r["length"]))
    assert all(sum(n for _, n in b) <= corpus_pipeline.BIN_WORDS and len({d for d, _ in b}) == len(b) for b in fill.values())


def test_run_equals_the_stages(spark, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, TINY).collect())) == sorted(map(str, steps[5].collect()))


def test_stages_take_odd_rows(spark, documents):
    rng = random.Random(1)
    text = " ".join(rng.choice("the of and to in is".split()) for _ in range(80))
    docs = documents([(1, text, "en", "s"), (2, text, "en", "s"), (None, text + " x", "en", None), (3, None, None, None), (4, "", "en", "s"), (5, "1 2 3", None, "s"), (6, "une autre chose", "fr", "s"), (6, "une autre chose", "fr", "s")])
    for start in (docs, docs.limit(0)):
        frame, work = start, Workspace(spark, "t")
        for name, stage in corpus_pipeline.STAGES:
            if name != "packing":
                assert frame.columns == docs.columns
            frame = work.save(stage(spark, frame, TINY), name)
            if name == "near_duplicates" and start is docs:
                kept = sorted((r["doc_id"] or 0 for r in frame.collect()))
                assert kept == [0, 1, 6, 6]


def test_stages_take_odd_column_names_and_repeated_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int, `my col` int, `a.b` string, _kept string, _row int, `x``y` string, variant int, row int, n_removed int, score double"
    docs = [r for r in spark.read.parquet(f"{TINY}/documents.parquet").orderBy("doc_id").collect()]
    long = " ".join(f"word{k}" for k in range(60))
    made = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, k, "ab", "k", k, "xy", 1, 2, 3, 0.5) for k, r in enumerate(docs)]
    extra = [(docs[0].doc_id, docs[5].text), (10**6, docs[3].text + " " + long), (10**6, "another " + long), (None, docs[2].text), (10**6 + 1, None), (10**6 + 2, "")]
    made += [(d, t, "en", None, None, -1, "ab", "k", -1, "xy", 1, 2, 3, 0.5) for d, t in extra]
    df = spark.createDataFrame(made, schema)
    work = Workspace(spark, "odd")
    for name, stage in corpus_pipeline.STAGES:
        out = work.save(stage(spark, df, TINY), name)
        if name != "packing":
            assert out.columns == df.columns
            assert {(r["a.b"], r["_kept"], r["x`y"], r["variant"], r["score"]) for r in out.collect()} == {("ab", "k", "xy", 1, 0.5)}
        df = out
    assert df.count() > 100
