"""A hierarchical Pitman-Yor language model over words.

Restaurants: one per context, all with the same parent, the restaurant of single words, whose own base is uniform over
the words known and one unknown word. The context of a word is the word before it; the start of a text is a context too.
Module ``word_contexts`` seats this model. With ``context_part`` only a frequent word before it (at least one in
``context_part`` of all tokens, so there are at most that many contexts) is a context of its own, all rarer words share one,
and what follows here and in this module holds.

Customers are counted over the whole training text. Per dish only the number of tables matters, and Gibbs sampling
draws it from its conditional distribution: generalised Stirling numbers times the strength of the restaurant times the
predictive probability of the parent without the tables in question. Dishes with very many customers seat the first of
them this way; the number of tables that the rest open, one after another, is drawn from the normal law with the mean
and variance of those independent chances. A sweep resamples every dish from the state of the sweep before, so words
need not wait for each other; only the table totals of the at most ``context_part`` + 2 restaurants are exchanged
between rounds. Predictive probabilities are averaged over the sweeps after the first ones. They add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.store import Workspace
from fleetmart.llm.words import each_slice, mix

#: Token of the end of a text; no word has this fingerprint by construction of chance.
END = np.uint64(0x5EED0F7E47E4D001)
OTHER, START = 0, 1


@dataclass(frozen=True)
class PitmanYor:
    """Parameters."""

    #: None: every previous word has its restaurant. A number: only words of at least that part of all tokens.
    context_part: int | None = None
    strength: float = 1.0
    burn_in: int = 2
    samples: int = 4
    #: Customers of a dish whose tables are drawn from the exact conditional.
    exact_customers: int = 40
    #: Training tokens per block of documents that are scored together.
    block_tokens: int = 5_000_000


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, tokens, first token per text): the words of successive texts, each text closed by END."""
    for i, j, h, first in each_slice(column, lower=True):
        document = np.repeat(np.arange(j - i), np.diff(first))
        out = np.full(len(h) + j - i, END)
        out[np.arange(len(h)) + document] = h
        yield i, j, out, first + np.arange(j - i + 1)


def _contexts(tokens: np.ndarray, first: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Context of every token: OTHER, START or 2 + place among the frequent words."""
    out = np.zeros(len(tokens), np.int64)
    if len(frequent) and len(tokens):
        at = np.minimum(np.searchsorted(frequent, tokens[:-1]), len(frequent) - 1)
        out[1:] = np.where(frequent[at] == tokens[:-1], at + 2, OTHER)
    out[first[:-1]] = START
    return out


class _Counter:
    """Adds up counts of 64-bit keys; memory follows the number of different keys, and every key is merged a few times only."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._new.append((keys, counts))
        self._waiting += len(keys)
        if self._waiting > max(len(self.keys), 500_000):
            self.merge()

    def merge(self) -> None:
        if self._new:
            keys, place = np.unique(np.concatenate([self.keys, *[k for k, _ in self._new]]), return_inverse=True)
            self.counts = np.bincount(place, np.concatenate([self.counts, *[c for _, c in self._new]]), len(keys)).astype(np.int64)
            self.keys, self._new, self._waiting = keys, [], 0


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 60_000) -> Iterator[pa.RecordBatch]:
    """Batches joined to at least so many rows, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = _Counter()
    for batch in batches:
        parts = [t for _, _, t, _ in _tokens(batch.column("text"))]
        if parts:
            total.add(*np.unique(np.concatenate(parts), return_counts=True))
    total.merge()
    yield pa.RecordBatch.from_arrays([pa.array(total.keys.view(np.int64)), pa.array(total.counts)], ["w", "n"])


def _pair_counter(frequent: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Few contexts: one counter for each keeps keys at 64 bits.
        totals = [_Counter() for _ in range(len(frequent) + 2)]
        for batch in batches:
            tokens, contexts = [], []
            for _, _, t, first in _tokens(batch.column("text")):
                tokens.append(t)
                contexts.append(_contexts(t, first, frequent))
            if not tokens:
                continue
            t, c = np.concatenate(tokens), np.concatenate(contexts)
            order = np.argsort(c, kind="stable")
            edges = np.searchsorted(c[order], np.arange(len(totals) + 1))
            for k, total in enumerate(totals):
                if edges[k + 1] > edges[k]:
                    total.add(*np.unique(t[order[edges[k] : edges[k + 1]]], return_counts=True))
        for k, total in enumerate(totals):
            total.merge()
            if len(total.keys):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(total.keys.view(np.int64)), pa.array(np.full(len(total.keys), k, np.int16)), pa.array(total.counts)], ["w", "ctx", "n"]
                )

    return count


@dataclass
class Totals:
    """What all restaurants know of each other: small arrays by context, and the numbers of the parent."""

    customers: np.ndarray
    tables: np.ndarray
    words: int
    parent_tables: float
    discount: float
    parent_discount: float
    strength: float

    @property
    def parent_customers(self) -> float:
        return float(self.tables.sum())

    @property
    def base(self) -> float:
        return 1 / (self.words + 1)

    def parent(self, customers, tables):
        """Predictive probability of a word in the parent from its customers and tables there."""
        c, d, s = self.parent_customers, self.parent_discount, self.strength
        return (customers - d * tables) / (s + c) + (s + d * self.parent_tables) / (s + c) * self.base

    def back_off(self) -> np.ndarray:
        """Weight of the parent by context."""
        return (self.strength + self.discount * self.tables) / (self.strength + self.customers)


def log_stirling(discount: float, most: int) -> np.ndarray:
    """log of the generalised Stirling numbers S(c, t) for c and t up to ``most``."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for c in range(most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            out[c + 1, t] = np.logaddexp(out[c, t - 1], np.log(np.maximum(c - discount * t, 0)) + out[c, t])
    return out


def _hashes(*parts, start=np.uint64(0x243F6A8885A308D3)) -> np.ndarray:
    h = start
    for p in parts:
        h = mix(np.asarray(p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h)
    return h


def _uniform(*parts, start=np.uint64(0x243F6A8885A308D3)) -> np.ndarray:
    """Draws from (0, 1) by the parts; ``start`` are the hashes of parts before these."""
    return ((_hashes(*parts, start=start) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def sample_tables(c: np.ndarray, strength: np.ndarray, discount: float, stirling: np.ndarray, chance, draw: np.ndarray, draw2: np.ndarray) -> np.ndarray:
    """Tables of dishes with c customers. ``strength`` is strength + discount * other tables of the restaurant;
    ``chance(rows, i)`` the parent's probability of the dish when i of its tables stand."""
    exact = len(stirling) - 1
    out = np.ones(len(c), np.int64)
    few = np.minimum(c, exact)
    for size in np.unique(few[few > 1]):
        rows = np.flatnonzero(few == size)
        steps = np.arange(size)
        # A line per number of tables: long lines are worked on faster than many short ones.
        gain = np.log(strength[rows] + discount * steps[:, None]) + np.log(chance(rows, steps).T, order="C")
        weight = stirling[size, 1 : size + 1, None] + np.cumsum(gain, 0)
        share = np.cumsum(np.exp(weight - weight.max(0)), 0)
        out[rows] = np.minimum((share < draw[rows] * share[-1]).sum(0) + 1, size)
    rows = np.flatnonzero(c > exact)
    if len(rows):
        a = strength[rows] * chance(rows, np.array([0]))[:, 0]
        x, m = exact - discount * out[rows], c[rows] - exact
        mean = np.minimum(a * np.log((a + x + m) / (a + x)), m)
        spread = np.sqrt(np.maximum(mean - np.minimum(a * a * (1 / (a + x) - 1 / (a + x + m)), mean), 0))
        normal = np.sqrt(-2 * np.log(draw2[rows])) * np.cos(2 * np.pi * draw[rows])
        out[rows] += np.clip(np.rint(mean + spread * normal), 0, m).astype(np.int64)
    return out


def _gibbs(totals: Totals, params: PitmanYor):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = log_stirling(totals.discount, params.exact_customers)
        outer = log_stirling(totals.parent_discount, params.exact_customers)
        for batch in _gathered(batches):
            w = batch.column("w").to_numpy(zero_copy_only=False).view(np.uint64)
            lists = batch.column("seats")
            if not len(w):
                continue
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            seats = lists.flatten()
            ctx, n = (seats.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("ctx", "n"))
            word = np.repeat(np.arange(len(w)), sizes)
            edges = np.cumsum(sizes) - sizes
            t = np.ones(len(n), np.int64)
            above, tops = np.add.reduceat(t, edges), np.ones(len(w), np.int64)
            t_sum, above_sum, top_sum = np.zeros(len(n)), np.zeros(len(w)), np.zeros(len(w))
            open_ = np.flatnonzero(n > 1)
            c, d1, s = totals.parent_customers, totals.parent_discount, totals.strength
            for sweep in range(params.burn_in + params.samples):
                rows_w, rows_u = word[open_], ctx[open_]
                others = (above[rows_w] - t[open_]).astype(float)
                held = np.maximum(others - d1 * tops[rows_w], 0)
                fresh = (s + d1 * totals.parent_tables) * totals.base
                chance = lambda rows, i: (held[rows, None] + i + fresh) / (s + c + i)
                strength = s + totals.discount * np.maximum(totals.tables[rows_u] - t[open_], 0)
                draws = [_uniform(w[rows_w], rows_u, np.full(len(open_), 4 * sweep + k)) for k in (0, 1)]
                t[open_] = sample_tables(n[open_], strength, totals.discount, inner, chance, *draws)
                above = np.add.reduceat(t, edges)
                root = s + d1 * np.maximum(totals.parent_tables - tops, 0)
                base = lambda rows, i: np.full((len(rows), len(i)), totals.base)
                many = np.flatnonzero(above > 1)
                draws = [_uniform(w[many], np.full(len(many), 4 * sweep + k)) for k in (2, 3)]
                tops = np.ones(len(w), np.int64)
                tops[many] = sample_tables(above[many], root[many], d1, outer, base, *draws)
                if sweep >= params.burn_in:
                    t_sum += t
                    above_sum += above
                    top_sum += tops
            k = float(params.samples)
            kept = pa.ListArray.from_arrays(
                pa.array(np.concatenate((edges, [len(n)])).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(ctx.astype(np.int16)), pa.array(n), pa.array(t_sum / k)], ["ctx", "n", "t"]),
            )
            yield pa.RecordBatch.from_arrays([batch.column("w"), kept, pa.array(above_sum / k), pa.array(top_sum / k)], ["w", "seats", "above", "tops"])

    return run


_VALUE = np.dtype([("ctx", "<u2"), ("p", "<f8")])


def _pack(totals: Totals):
    """(w, c, parent probability, probabilities in the contexts without the parent's part) per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            lists = batch.column("seats")
            if not len(lists):
                continue
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            seats = lists.flatten()
            ctx, n, t = (seats.field(x).to_numpy(zero_copy_only=False) for x in ("ctx", "n", "t"))
            values = np.zeros(len(n), _VALUE)
            values["ctx"] = ctx
            values["p"] = (n - totals.discount * t) / (totals.strength + totals.customers[ctx])
            edges = np.concatenate(([0], np.cumsum(sizes)))
            packed = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer((edges * _VALUE.itemsize).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])
            count = np.add.reduceat(n, edges[:-1])
            above, tops = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("above", "tops"))
            yield pa.RecordBatch.from_arrays([batch.column("w"), pa.array(count.astype(np.int64)), pa.array(totals.parent(above, tops)), packed], ["w", "c", "p", "seats"])

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different tokens of every block."""
    found: dict[int, _Counter] = {}
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        for b in np.unique(block):
            mine = batch.column("text").filter(pa.array(block == b))
            parts = [t for _, _, t, _ in _tokens(mine)]
            found.setdefault(int(b), _Counter()).add(*np.unique(np.concatenate(parts), return_counts=True))
    for b, words in found.items():
        words.merge()
        yield pa.RecordBatch.from_arrays([pa.array(words.keys.view(np.int64)), pa.array(np.full(len(words.keys), b, np.int32))], ["w", "block"])


def _scorer(totals: Totals, frequent: np.ndarray, train_tokens: int):
    def score(texts: pa.Table, words: pa.Table) -> pa.Table:
        words = words.combine_chunks()
        w = words.column("w").to_numpy().view(np.uint64)
        order = np.argsort(w)
        w = w[order]
        c, p = (words.column(x).to_numpy()[order] for x in ("c", "p"))
        packed = words.column("seats").take(pa.array(order)).combine_chunks() if len(w) else None
        if packed is not None and isinstance(packed, pa.ChunkedArray):
            packed = pa.concat_arrays(packed.chunks)
        if len(w):
            ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(w) + 1]
            values = np.frombuffer(packed.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(_VALUE)
            owner = np.repeat(np.arange(len(w)), np.diff(ends) // _VALUE.itemsize)
            pairs = owner * 65536 + values["ctx"]
            by_pair = np.argsort(pairs, kind="stable")
            pairs, own = pairs[by_pair], values["p"][by_pair]
        unseen, back, n_words = totals.parent(0.0, 0.0), totals.back_off(), totals.words
        outs = [[], [], [], []]
        column = texts.column("text").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        for i, j, t, first in _tokens(column):
            context = _contexts(t, first, frequent)
            count, parent, direct = np.zeros(len(t), np.int64), np.full(len(t), unseen), np.zeros(len(t))
            if len(w):
                at = np.minimum(np.searchsorted(w, t), len(w) - 1)
                known = w[at] == t
                count, parent = np.where(known, c[at], 0), np.where(known, p[at], unseen)
                key = at * 65536 + context
                place = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                direct = np.where(known & (pairs[place] == key), own[place], 0.0)
            whole = np.log10(direct + back[context] * parent)
            base = np.log10((count + 1) / (train_tokens + n_words + 1))
            for out, values_ in zip(outs, (np.ones(len(t), np.int64), (count > 0).astype(np.int64), base, whole)):
                out.append(np.add.reduceat(values_, first[:-1]))
        n, known, base, whole = (np.concatenate(x) if x else np.zeros(0) for x in outs)
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array(n.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(n), train_tokens, np.int64)), "base_score": pa.array(base.astype(float)), "score": pa.array(whole.astype(float)),
        })

    return score


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class FittedModel:
    """The seated model: one row per known word, and the totals."""

    words: DataFrame
    totals: Totals
    frequent: np.ndarray = field(repr=False)
    train_tokens: int


def fit(texts: DataFrame, work: Workspace, params: PitmanYor = PitmanYor(context_part=200)) -> FittedModel:
    """Counts and seats the training texts (column text) with the contexts of ``context_part``."""
    counted = work.save(texts.mapInArrow(_count_words, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "words")
    row = counted.agg(F.count("*").alias("v"), F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    n_words, tokens = row["v"], row["n"] or 0
    # At most context_part words are that frequent.
    often = [r["w"] for r in counted.where(F.col("n") * params.context_part >= tokens).select("w").collect()]
    work.drop(counted)
    frequent = np.sort(np.array(often, np.int64).view(np.uint64))
    frequent = frequent[frequent != END]

    pairs = texts.mapInArrow(_pair_counter(frequent), "w long, ctx short, n long").groupBy("w", "ctx").agg(F.sum("n").alias("n"))
    seats = work.save(pairs.groupBy("w").agg(F.sort_array(F.collect_list(F.struct("ctx", "n"))).alias("seats")), "seats")
    one = F.explode("seats").alias("s")
    per = seats.select(one).groupBy("s.ctx").agg(
        F.sum("s.n").alias("c"), F.count("*").alias("t"), F.count_if(F.col("s.n") == 1).alias("n1"), F.count_if(F.col("s.n") == 2).alias("n2")
    ).collect()
    k = len(frequent) + 2
    customers, tables = np.zeros(k), np.zeros(k)
    for r in per:
        customers[r["ctx"]], tables[r["ctx"]] = r["c"], r["t"]
    discount = lambda n1, n2: float(np.clip(n1 / max(n1 + 2 * n2, 1), 0.05, 0.95))
    totals = Totals(customers, tables, n_words, float(n_words), discount(sum(r["n1"] for r in per), sum(r["n2"] for r in per)), discount(row["n1"], row["n2"]), params.strength)

    schema = "w long, seats array<struct<ctx: short, n: long, t: double>>, above double, tops double"
    for last in (False, True):
        seated = seats.mapInArrow(_gibbs(totals, params), schema)
        if last:
            seated = work.save(seated, "seated")
        # One pass gives both: the parent's tables ride along as context -1.
        parent = F.array(F.struct(F.lit(-1).cast("short").alias("ctx"), F.col("tops").alias("t")))
        both = seated.select(F.explode(F.concat(F.transform("seats", lambda x: F.struct(x["ctx"].alias("ctx"), x["t"].alias("t"))), parent)).alias("s"))
        sums = both.groupBy("s.ctx").agg(F.sum("s.t").alias("t")).collect()
        top = sum(r["t"] for r in sums if r["ctx"] == -1)
        tables = np.zeros(k)
        for r in sums:
            if r["ctx"] >= 0:
                tables[r["ctx"]] = r["t"]
        totals = Totals(customers, tables, n_words, float(top), totals.discount, totals.parent_discount, params.strength)
    work.drop(seats)
    return FittedModel(seated, totals, frequent, tokens)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", params: PitmanYor = PitmanYor()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Learns from the rows that are not held out. Scores are log10 probabilities of whole texts with their end; perplexity
    is 10 ^ (-score / n_tokens). A null text is empty and has the end as its only token. With nothing to learn from all
    tokens are unknown. Repeated rows are scored alike; an empty table gives an empty result; further columns are not read.
    """
    work = Workspace(docs.sparkSession, "pitman-yor", tidy=True)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), held_out.alias("held_out"))
    if params.context_part is None:
        from fleetmart.llm import word_contexts

        return word_contexts.score(texts, work, params, SCORES)
    model = fit(texts.where(~F.col("held_out")).select("text"), work, params)
    blocks = max(1, -(-model.train_tokens // params.block_tokens))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    asked = dealt.select("block", "text").mapInArrow(_asked, "w long, block int")
    packed = model.words.mapInArrow(_pack(model.totals), "w long, c long, p double, seats binary")
    told = asked.join(packed, "w").select("block", "w", "c", "p", "seats")
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_scorer(model.totals, model.frequent, model.train_tokens), SCORES)
