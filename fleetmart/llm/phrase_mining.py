"""Collocations of two to four words per language, with counts from suffix subtrees built group by group.

The suffixes of all pieces of text, cut off at the greatest phrase length, form a tree of words. It is partitioned
vertically: a prefix of two words owns the part of the tree below it; a prefix that occurs more often than the memory
budget of a group is extended by one word, and again if need be. Prefixes are dealt to groups of about one budget each.
Every group sorts its suffixes and builds its subtrees on its own; the total of the leaves below a node is the number of
occurrences of its phrase.

A phrase is no more frequent than any pair in it, so suffixes end before the first pair that is too rare. Which words and
pairs are frequent is told by Bloom filters of a bounded size; what these let through by chance is counted and dropped.

A word is its 64-bit fingerprint mixed with that of its language; a phrase is the chained fingerprint of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm import bloom
from fleetmart.llm.line_dedup import _cut_bytes
from fleetmart.llm.store import Workspace
from fleetmart.llm.words import fingerprints, flat, mix, slices, spans

#: Bytes that end a piece of text.
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
#: A to Z in lower case, breaks as spaces.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[_BREAKS] = 32
_CHAIN = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
#: Words gathered before they are counted.
GATHERED = 1_500_000


@dataclass(frozen=True)
class PhraseMining:
    """Parameters."""

    #: Words of the longest phrase.
    words: int = 4
    least: int = 30
    #: A phrase goes if a longer one around it has at least so many percent of its occurrences.
    percent: int = 80
    #: Phrases per language in the result.
    top: int = 2000
    #: Suffixes of a group.
    budget: int = 1_000_000
    most_bits: int = 1 << 27


def _stream(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, start, end, document, key, linked) of the words of successive ranges of texts; linked: the next word is in the same piece."""
    data, offsets = flat(batch.column("text"))
    language = mix(batch.column("language").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    for i, j in slices(offsets):
        raw, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        part = _PLAIN[raw]
        starts, ends, first = spans(part, edges)
        if not len(starts):
            continue
        document = np.repeat(np.arange(i, j), np.diff(first))
        key = mix(fingerprints(part, starts, ends) ^ language[document])
        piece = np.cumsum(_BREAKS[raw])[starts]
        linked = np.zeros(len(key), bool)
        linked[:-1] = (document[1:] == document[:-1]) & (piece[1:] == piece[:-1])
        yield part, starts, ends, document, key, linked


def chained(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Fingerprint of a phrase from that of all but its last word; the fingerprint of one word is its key."""
    return mix(prefix * _CHAIN + word)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, starts, ends, document, key, _ in _stream(batch):
            keys, at, n = np.unique(key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(document[at])), pa.array(keys.view(np.int64)), _cut_bytes(part, starts[at], ends[at]), pa.array(n.astype(np.int64))], ["lang", "key", "word", "n"]
            )


def _in_chunks(found: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    held, size = [], 0
    for x in found:
        held.append(x)
        size += len(x)
        if size >= GATHERED:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def _pair_counter(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value

        def pairs():
            for batch in batches:
                for *_, key, linked in _stream(batch):
                    often = known.has(key)
                    at = np.flatnonzero(linked[:-1] & often[:-1] & often[1:])
                    yield chained(key[at], key[at + 1])

        for chunk in _in_chunks(pairs()):
            keys, n = np.unique(chunk, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["p", "n"])

    return run


def _suffixes(batch: pa.RecordBatch, pairs: bloom.BloomFilter, depth: int) -> Iterator[np.ndarray]:
    """(suffix, word) keys of all suffixes that begin with a frequent pair, cut before the first rare one; 0 where there is no word."""
    for *_, key, linked in _stream(batch):
        at = np.flatnonzero(linked)
        often = np.zeros(len(key), bool)
        often[at] = pairs.has(chained(key[at], key[at + 1]))
        starts = np.flatnonzero(often)
        out = np.zeros((len(starts), depth), np.uint64)
        out[:, 0], out[:, 1] = key[starts], key[starts + 1]
        goes_on = np.ones(len(starts), bool)
        for d in range(2, depth):
            before = np.minimum(starts + d - 1, len(key) - 1)
            goes_on &= often[before]
            out[goes_on, d] = key[starts[goes_on] + d]
        yield out


def _chains(suffix: np.ndarray) -> np.ndarray:
    """(suffix, length - 1) fingerprints of the prefixes of every suffix; padded words count."""
    out = np.empty_like(suffix)
    out[:, 0] = suffix[:, 0]
    for d in range(1, suffix.shape[1]):
        out[:, d] = chained(out[:, d - 1], suffix[:, d])
    return out


def _distinct(suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, at, n = np.unique(_chains(suffix)[:, -1], return_index=True, return_counts=True)
    return suffix[at], n.astype(np.int64)


def _hot_counter(pairs, depth: int, hot: list[np.ndarray]):
    """Counts of the prefixes of ``depth`` words below the hot ones of one word less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pairs.value
        under = (s[np.isin(_chains(s)[:, depth - 2], hot[-1])] for batch in batches for s in _suffixes(batch, known, depth))
        for chunk in _in_chunks(under):
            s, n = _distinct(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(list(s.view(np.int64)), pa.list_(pa.int64())), pa.array(n)], ["words", "n"])

    return run


def _dealer(pairs, params: PhraseMining, hot: list[np.ndarray], groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pairs.value
        for chunk in _in_chunks(s for batch in batches for s in _suffixes(batch, known, params.words)):
            s, n = _distinct(chunk)
            chains = _chains(s)
            owner, stays = chains[:, 1].copy(), np.ones(len(s), bool)
            for d, keys in enumerate(hot):
                # A hot prefix is extended; a suffix that ends with it was counted when it was found to be hot.
                longer = np.isin(chains[:, d + 1], keys) & stays
                stays &= ~(longer & (s[:, d + 2] == 0))
                owner[longer] = chains[longer, d + 2]
            group = (mix(owner) % np.uint64(groups)).astype(np.int64)
            at = np.flatnonzero(stays)
            at = at[np.argsort(group[at], kind="stable")]
            names, sizes = np.unique(group[at], return_counts=True)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            words = pa.ListArray.from_arrays(pa.array((edges * params.words).astype(np.int32)), pa.array(s[at].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(names), words, pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(n[at]))], ["group", "words", "n"])

    return run


def subtree(suffix: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, occurrences) of all nodes of two words and more, one depth after another, from sorted suffixes."""
    order = np.lexsort(suffix.T[::-1])
    suffix, n = suffix[order], n[order]
    new = np.zeros(len(suffix), bool)
    new[:1] = True
    new[1:] = suffix[1:, 0] != suffix[:-1, 0]
    for d in range(1, suffix.shape[1]):
        new[1:] |= suffix[1:, d] != suffix[:-1, d]
        heads = np.flatnonzero(new)
        if len(heads):
            node = suffix[heads].copy()
            node[:, d + 1 :] = 0
            total = np.add.reduceat(n, heads)
            real = node[:, d] != 0
            yield node[real], total[real]


def _described(node: np.ndarray, total: np.ndarray, size: int) -> pa.RecordBatch:
    """Nodes with the fingerprints that the scores need: (p, n, words, cuts, inner)."""
    words = [node[:, i] for i in range(size)]
    part = {}
    for i in range(size):
        part[i, i + 1] = words[i]
        for j in range(i + 1, size):
            part[i, j + 1] = chained(part[i, j], words[j])
    signed = lambda names: np.stack([part[x] for x in names], 1).view(np.int64)
    lists = lambda x: pa.ListArray.from_arrays(pa.array((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32)), pa.array(np.ascontiguousarray(x).ravel()))
    inner = [(i, j) for i in range(size) for j in range(i + 2, size + 1) if j - i < size]
    none = np.zeros((len(node), 0), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part[0, size].view(np.int64)), pa.array(total), lists(node[:, :size].view(np.int64)), lists(signed([(0, k) for k in range(1, size)])),
            lists(signed([(k, size) for k in range(1, size)])), lists(signed(inner) if inner else none),
        ],
        ["p", "n", "words", "lefts", "rights", "inner"],
    )


NODES = "p long, n long, words array<long>, lefts array<long>, rights array<long>, inner array<long>"


def _subtrees(params: PhraseMining, hot: list[np.ndarray]):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        s = np.concatenate([x.values.to_numpy()[x.offsets[0].as_py() : x.offsets[-1].as_py()] for x in rows.column("words").chunks]).view(np.uint64).reshape(-1, params.words)
        n = np.concatenate([x.values.to_numpy()[x.offsets[0].as_py() : x.offsets[-1].as_py()] for x in rows.column("n").chunks])
        out = []
        for d, (node, total) in enumerate(subtree(s, n), 2):
            # The subtree of a hot prefix is spread over groups; its own number is known already.
            whole = total >= params.least
            if d - 2 < len(hot):
                whole &= ~np.isin(_chains(node[:, :d])[:, -1], hot[d - 2])
            out.append(_described(node[whole], total[whole], d))
        return pa.Table.from_batches(out)

    return run


def _describer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("words").to_pylist()
        for size in sorted({len(x) for x in lists}):
            at = [i for i, x in enumerate(lists) if len(x) == size]
            yield _described(np.array([lists[i] for i in at], np.int64).view(np.uint64).reshape(-1, size), batch.column("n").to_numpy()[at].astype(np.int64), size)


def _filter(keys: DataFrame, count: int, params: PhraseMining, work: Workspace) -> bloom.BloomFilter:
    bits = bloom.filter_bits(count, 16, params.most_bits)
    found = lambda batches: bloom.gathered_parts((b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches), bits)
    return bloom.merged(keys.mapInArrow(found, bloom.PARTS), bits, work, "once")


def frequent_phrases(texts: DataFrame, vocabulary: DataFrame, params: PhraseMining, work: Workspace) -> DataFrame:
    """All phrases of two words and more with their occurrences (columns of ``NODES``), from (text, lang, language) and the frequent words."""
    sc = texts.sparkSession.sparkContext
    words = sc.broadcast(_filter(vocabulary.select("key"), vocabulary.count(), params, work))
    counted = texts.mapInArrow(_pair_counter(words), "p long, n long").groupBy("p").agg(F.sum("n").alias("n"))
    pairs = work.save(counted.where(F.col("n") >= params.least), "pairs")
    told = pairs.agg(F.count("*").alias("pairs"), F.sum("n").alias("n")).first()
    known = sc.broadcast(_filter(pairs.select("p"), told["pairs"], params, work))
    # At most one in ``budget`` suffixes is the first of a hot prefix, so these lists are short.
    first = pairs.where((F.col("n") > params.budget) & F.lit(params.words > 2)).select("p").collect()
    hot = [np.sort(np.array([r["p"] for r in first], np.int64).view(np.uint64))]
    spread: list[DataFrame] = []
    while len(hot[-1]) and len(hot) + 2 <= params.words:
        d = len(hot) + 2
        below = work.save(texts.mapInArrow(_hot_counter(known, d, hot), "words array<long>, n long").groupBy("words").agg(F.sum("n").alias("n")), "hot")
        spread.append(below.groupBy(F.slice("words", 1, d - 1).alias("words")).agg(F.sum("n").alias("n")))
        if d == params.words:
            break
        more = [r["words"] for r in below.where((F.col("n") > params.budget) & (F.element_at("words", d) != 0)).select("words").collect()]
        hot.append(np.sort(_chains(np.array(more, np.int64).view(np.uint64).reshape(-1, d))[:, -1]))
    hot = [x for x in hot if len(x)]
    groups = max(1, -(-(told["n"] or 0) // params.budget))
    dealt = texts.mapInArrow(_dealer(known, params, hot, groups), "group long, words array<long>, n array<long>")
    nodes = dealt.groupBy("group").applyInArrow(_subtrees(params, hot), NODES)
    for counts in spread:
        nodes = nodes.unionByName(counts.mapInArrow(_describer, NODES))
    return work.save(nodes, "nodes")


def mine_phrases(docs: DataFrame, params: PhraseMining = PhraseMining(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language.

    Texts in lower case (A-Z) are cut at ``.,;:!?`` and line ends; words of a piece are what spaces and tabs part. A phrase
    of two words and more with a >= ``least`` occurrences is a candidate. A cut into occurrences l and r of its two sides
    scores floor(2000000 * a / (l + r)); the lowest cut counts, the first of equal ones. Candidates that a longer one
    holds with at least ``percent`` of their occurrences go. Rank is by score, a (both falling) and phrase; n counts all
    words of the language.

    A null language is ``und``, together with rows that say so; a null or empty text has no words. Repeated rows count
    as often as they occur. An empty table gives an empty result; further columns are not read.
    """
    if params.words < 2:
        raise ValueError("a phrase has two words at least")
    work = Workspace(docs.sparkSession, "phrases")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    texts = docs.select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("language")).where(F.col("text") != "")
    words = texts.mapInArrow(_count_words, "lang string, key long, word string, n long").groupBy("lang", "key", "word").agg(F.sum("n").alias("n"))
    words = work.save(words, "words")
    totals = work.save(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    vocabulary = work.save(words.where(F.col("n") >= params.least), "vocabulary")
    work.drop(words)
    nodes = frequent_phrases(texts, vocabulary, params, work)

    counts = work.save(nodes.select("p", "n").unionByName(vocabulary.select(F.col("key").alias("p"), "n")), "counts")
    cuts = nodes.select("p", "n", F.explode(F.arrays_zip("lefts", "rights", F.sequence(F.lit(1), F.size("lefts")).alias("k"))).alias("cut"))
    cuts = cuts.select("p", "n", "cut.k", F.col("cut.lefts").alias("left"), F.col("cut.rights").alias("right"))
    side = lambda key, name: counts.select(F.col("p").alias(key), F.col("n").alias(name))
    both = cuts.join(side("left", "l"), "left").join(side("right", "r"), "right")
    score = F.expr("cast(cast(n as decimal(38,0)) * 2000000 div cast(l + r as decimal(38,0)) as long)")
    best = both.groupBy("p").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    around = nodes.select(F.explode(F.array_distinct("inner")).alias("p"), "n").groupBy("p").agg(F.max("n").alias("longer"))
    held = nodes.join(work.save(around, "around"), "p", "left").where(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("n").cast("decimal(38,0)") * params.percent))
    kept = work.save(held.join(work.save(best, "best"), "p").select("p", F.col("n").alias("a"), "words", "best.*"), "kept")

    placed = kept.select("p", F.posexplode("words").alias("place", "key"))
    named = placed.join(vocabulary.select("key", "word", "lang"), "key").groupBy("p", "lang").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("named"))
    named = named.select("p", "lang", F.array_join(F.transform("named", lambda x: x["word"]), " ").alias("phrase"))
    ranked = kept.join(work.save(named, "named"), "p").withColumn("rank", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)"))
    first = ranked.where(F.col("rank") <= params.top).join(totals, "lang")
    return first.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
