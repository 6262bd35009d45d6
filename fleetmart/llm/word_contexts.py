"""The Pitman-Yor model of ``pitman_yor`` with a restaurant for every previous word, whatever its frequency.

Texts become chunks of numbered words (``word_chunks``), read once. Every chunk sends the fingerprints of its different pairs
to buckets of equal ranges of fingerprints. There they are counted over all chunks, and every chunk is told which of its pairs
training texts hold never, once or more often; one of the chunks that show a pair seen more often is its owner and learns the
count. A pair seen once has one table for certain, so it is never stored, and only pairs seen more often are seated, each as
one row from its owner.

Nothing grows on the driver: words and seated pairs are Spark tables. The seated pairs are grouped by word, with the table total
of each context joined in; a word with very many contexts is cut into pieces that see each other's tables as of the round
before. Table totals of contexts and the numbers of the parent are exchanged between rounds. A context that was never
seen passes on to the parent whole. The predictive probability of a token is formed for every kept sweep, with that sweep's
tables in all restaurants, and then averaged.

Every text begins behind END, so a context is itself a word of the model and has as many customers as that word has tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.pitman_yor import PitmanYor, _hashes, _uniform, log_stirling, sample_tables
from fleetmart.llm.store import Workspace
from fleetmart.llm.word_chunks import CHUNKS, Chunk, by_bucket, chunks, each_chunk, pack, pack_sorted, pair_keys, runs, unpack, unpack_sorted

#: Seated pairs per row of the sampler, and per batch it works on.
PIECE, BATCH = 20_000, 100_000
#: Rows of an Arrow batch on the way to the sampler.
ROWS = 20_000
#: Fingerprints of a bucket, counted over the chunks that send them: of pairs to be counted, and of words asked for with all
#: their numbers. Both bound the memory of a task.
BUCKET, WANTED = 2_000_000, 500_000
#: What a chunk is told of a pair: its count in training texts plus one to the owner, else one of these.
NEVER, ONCE, OFTEN = 0, 1, 2


def pair_key() -> Column:
    """64-bit fingerprint of a word (w) behind a context (ctx)."""
    return F.col("w").bitwiseXOR(F.xxhash64("ctx"))


def _asking(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in each_chunk(batches):
            rows = [(b, pack_sorted(c.keys[at]), pack(c.trained[at])) for b, at in by_bucket(c.keys, buckets)]
            b, keys, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array([c.number] * len(b), pa.int64()), pa.array(keys, pa.binary()), pa.array(n, pa.binary())], ["bucket", "chunk", "keys", "n"])

    return run


def _count(asked: pa.Table) -> pa.Table:
    """What every chunk is told of its pairs in one bucket."""
    keys = [unpack_sorted(x.as_py()) for x in asked.column("keys")]
    n = np.concatenate([unpack(x.as_py(), np.int64) for x in asked.column("n")])
    sent = np.concatenate(keys)
    order = np.argsort(sent)
    start = runs(sent[order])
    total = np.add.reduceat(n[order], start)
    told = np.empty(len(sent), np.int64)
    told[order] = np.repeat(np.minimum(total, OFTEN), np.diff(start, append=len(sent)))
    owned = total > 1
    told[order[start[owned]]] = total[owned] + 1
    edges = np.cumsum([len(k) for k in keys])[:-1]
    answers = [pack(x.astype(np.uint64)) for x in np.split(told, edges)]
    return pa.table({"bucket": asked.column("bucket"), "chunk": asked.column("chunk"), "told": pa.array(answers, pa.binary())})


def _tell(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    told = [x["told"] for x in sorted(answers.to_pylist(), key=lambda x: x["bucket"])]
    whole = pack(np.concatenate([unpack(x, np.uint64) for x in told]))
    return chunk.append_column("told", pa.array([whole], pa.binary()))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk and word: tokens, and pairs seen once, seen more often and seen twice by word and by context."""
    for c in each_chunk(batches):
        w, ctx = c.pairs
        size = len(c.words)
        n = np.bincount(c.tokens, c.in_training, size)
        once, owned, twice = (c.told == ONCE) & (c.trained > 0), c.told > OFTEN, c.told == 3
        found = [n, *(np.bincount(x, y, size) for y in (once, owned) for x in (w, ctx)), np.bincount(w, twice, size)]
        keep = np.flatnonzero(np.any(found, axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.words[keep].view(np.int64)), *(pa.array(x[keep].astype(np.int64)) for x in found)], ["w", "n", "singles", "tails", "more", "back", "twice"]
        )


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs to be seated."""
    for c in each_chunk(batches):
        at = np.flatnonzero(c.told > OFTEN)
        w, ctx = (c.words[x[at]].view(np.int64) for x in c.pairs)
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(ctx), pa.array(c.told[at].astype(np.int64) - 1)], ["w", "ctx", "n"])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in each_chunk(batches):
        yield pa.RecordBatch.from_arrays([pa.array(c.keys[(c.told == ONCE) & (c.trained > 0)].view(np.int64))], ["key"])


@dataclass
class Parent:
    """Numbers of the parent restaurant and the parameters of all."""

    customers: float
    tables: float
    words: int
    discount: float
    parent_discount: float
    strength: float

    @property
    def base(self) -> float:
        return 1 / (self.words + 1)

    def chance(self, customers, tables):
        """Predictive probability of a word in the parent; works on numbers, arrays and columns."""
        s, d = self.strength, self.parent_discount
        return (customers - tables * d) / (s + self.customers) + (s + d * self.tables) / (s + self.customers) * self.base


@dataclass
class Sweeps:
    """The parent in every kept sweep; ``chance`` is the mean of theirs."""

    parents: list[Parent]

    @property
    def words(self) -> int:
        return self.parents[0].words

    @property
    def discount(self) -> float:
        return self.parents[0].discount

    @property
    def strength(self) -> float:
        return self.parents[0].strength

    def chance(self, customers, tables):
        return sum(p.chance(customers, tables) for p in self.parents) / len(self.parents)


def _whole_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, whether a row is a word's own): joined batches that end where a word's rows end; a word's own row comes first."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BATCH:
            rows = pa.concat_batches(held)
            own = rows.column("ctx").is_null().to_numpy(zero_copy_only=False)
            last = int(np.flatnonzero(own)[-1])
            if last:
                yield rows.slice(0, last), own[:last]
            held, n = [rows.slice(last)], len(own) - last
    if n:
        rows = pa.concat_batches(held)
        yield rows, rows.column("ctx").is_null().to_numpy(zero_copy_only=False)


def _numbered(x: str, width: int) -> list[str]:
    return [f"{x}{i}" for i in range(width)]


def _seated(width: int) -> str:
    """A word's own row (no ctx: its tokens and pairs seen once, all its tables in the piece, and its tables in the parent), and
    one for each of its seated pairs; ``width`` numbers of tables each."""
    return ", ".join(["w long, piece int, ctx long, n long, singles long", *(f"{x} int" for x in _numbered("t", width) + _numbered("tops", width))])


def _gibbs(parent: Parent, params: PitmanYor, width: int):
    """Tables of the kept sweeps, by sweep or (``width`` 1) in sum."""
    samples = params.samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = log_stirling(parent.discount, params.exact_customers)
        outer = log_stirling(parent.parent_discount, params.exact_customers)
        for batch, head in _whole_words(batches):
            fill = lambda x: batch.column(x).fill_null(0).to_numpy(zero_copy_only=False)
            seat = ~head
            w, singles = fill("w")[head].view(np.uint64), fill("singles")[head]
            word = np.cumsum(head)[seat] - 1
            ctx, n, k = (fill(x)[seat] for x in ("ctx", "n", "k"))
            # A piece of a word sees the tables of the others as of the round before, in the first round one for each pair.
            total, before = (batch.column(x).to_numpy(zero_copy_only=False)[head] for x in ("k", "own"))
            here = np.where(np.isnan(before), np.bincount(word, minlength=len(w)), before)
            fixed = singles + np.where(np.isnan(total), 0.0, total - here)
            of = ctx.view(np.uint64)
            # Only dishes with many customers need a second draw.
            by_pair, by_word, crowd = _hashes(w[word], of), _hashes(w), n > params.exact_customers
            second = np.zeros(len(n))
            t = np.ones(len(n), np.int64)
            own = np.bincount(word, t, len(w))
            above, tops = own + fixed, np.ones(len(w), np.int64)
            kept_t, kept_own, kept_tops = [], [], []
            c, d1, s = parent.customers, parent.parent_discount, parent.strength
            fresh = (s + d1 * parent.tables) * parent.base
            for sweep in range(params.burn_in + samples):
                held = np.maximum(above[word] - t - d1 * tops[word], 0)
                chance = lambda rows, i: (held[rows, None] + i + fresh) / (s + c + i)
                strength = s + parent.discount * np.maximum(k - t, 0)
                second[crowd] = _uniform(4 * sweep + 1, start=by_pair[crowd])
                t = sample_tables(n, strength, parent.discount, inner, chance, _uniform(4 * sweep, start=by_pair), second)
                own = np.bincount(word, t, len(w))
                above = own + fixed
                root = s + d1 * np.maximum(parent.tables - tops, 0)
                base = lambda rows, i: np.full((len(rows), len(i)), parent.base)
                many = np.flatnonzero(above > 1)
                draws = [_uniform(4 * sweep + x, start=by_word[many]) for x in (2, 3)]
                tops = np.ones(len(w), np.int64)
                tops[many] = sample_tables(np.rint(above[many]).astype(np.int64), root[many], d1, outer, base, *draws)
                if sweep >= params.burn_in:
                    kept_t.append(t)
                    kept_own.append(own)
                    kept_tops.append(tops)
            if width < samples:
                kept_t, kept_own, kept_tops = ([np.sum(x, 0)] for x in (kept_t, kept_own, kept_tops))
            tables = []
            for in_pairs, in_words in [*zip(kept_t, kept_own), *((0, x) for x in kept_tops)]:
                column = np.empty(len(head), np.int32)
                column[seat], column[head] = in_pairs, in_words
                tables.append(column)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("w", "piece", "ctx", "n", "singles")), *map(pa.array, tables)],
                ["w", "piece", "ctx", "n", "singles", *_numbered("t", width), *_numbered("tops", width)],
            )

    return run


@dataclass
class WordModel:
    """words (w, c, above, tops, ks, p, back): tokens, customers and tables in the parent and tables as a context by sweep, the
    mean probability in the parent, and the mean weight of the parent where w is the context; seats (w, ctx, n, t): seated
    pairs with the sum of their tables over the sweeps; pairs (key, v): customers less discounted tables of every pair."""

    words: DataFrame
    seats: DataFrame
    pairs: DataFrame
    parent: Sweeps
    train_tokens: int


def _mean(x: str, samples: int) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, t: a + t) / samples


def _total(x: str, width: int) -> Column:
    return reduce(lambda a, b: a + b, (F.col(y).cast("double") for y in _numbered(x, width)))


def _by_sweep(x: str, width: int, over=F.sum) -> list[Column]:
    return [over(y).cast("double").alias(y) for y in _numbered(x, width)]


def _read(texts: DataFrame, work: Workspace) -> DataFrame:
    """Chunks of the texts (doc_id, held_out, text), told of their pairs."""
    read = work.save(texts.select("doc_id", "held_out", "text").mapInArrow(chunks, CHUNKS), "chunks")
    tokens = read.agg(F.sum("n_tokens")).first()[0] or 0
    asked = read.mapInArrow(_asking(max(1, -(-tokens // BUCKET))), "bucket int, chunk long, keys binary, n binary")
    answers = work.save(asked.groupBy("bucket").applyInArrow(_count, "bucket int, chunk long, told binary"), "answers")
    told = work.save(read.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_tell, CHUNKS + ", told binary"), "told")
    work.drop(read)
    work.drop(answers)
    return told


def _seat(told: DataFrame, work: Workspace, params: PitmanYor) -> WordModel:
    m, numbers = params.samples, ["n", "singles", "tails", "more", "back", "twice"]
    words = work.save(told.mapInArrow(_words, ", ".join(["w long", *(f"{x} long" for x in numbers)])).groupBy("w").agg(*(F.sum(x).alias(x) for x in numbers)), "words")
    # A word of a single token has one table there and in the parent for certain and is not sampled.
    lone = (F.col("singles") == 1) & (F.col("more") == 0)
    v = words.agg(
        F.count("*").alias("words"), F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"),
        F.sum(F.col("singles") + F.col("more")).alias("pairs"), F.sum("singles").alias("u1"), F.sum("twice").alias("u2"), F.count_if(lone).alias("lone"),
    ).first()
    n = {x: v[x] or 0 for x in ("words", "n", "n1", "n2", "pairs", "u1", "u2", "lone")}
    discount = lambda n1, n2: float(np.clip(n1 / max(n1 + 2 * n2, 1), 0.05, 0.95))
    inner, outer = discount(n["u1"], n["u2"]), discount(n["n1"], n["n2"])
    parent = Parent(float(n["pairs"]), float(n["words"]), n["words"], inner, outer, params.strength)

    # At most one row for every PIECE pairs; not all of a large table's need fit a broadcast, so Spark chooses.
    large = words.where(F.col("more") > PIECE).select("w", F.ceil(F.col("more") / PIECE).cast("int").alias("pieces"), F.col("more").cast("double").alias("total"))
    pieces = F.coalesce("pieces", F.lit(1))
    owned = told.mapInArrow(_owned, "w long, ctx long, n long")
    seats = owned.join(large, "w", "left").select("w", F.pmod(F.xxhash64("ctx"), pieces).cast("int").alias("piece"), "ctx", "n")
    rows = words.where(~lone).join(large, "w", "left").select("w", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), "n", "singles", F.lit(None).cast("double").alias("own"))
    contexts = words.select(F.col("w").alias("ctx"), "tails", "back")
    totals = contexts.where("back > 0").select("ctx", (F.col("tails") + F.col("back")).cast("double").alias("k"))
    old = []
    for width in (1, m):
        heads = rows.join(large.select("w", F.col("total").alias("k")), "w", "left").withColumn("ctx", F.lit(None).cast("long"))
        asked = heads.unionByName(seats.join(totals, "ctx"), allowMissingColumns=True).select("w", "piece", "ctx", "n", "k", "singles", "own")
        asked = asked.repartition("w", "piece").sortWithinPartitions("w", "piece", F.col("ctx").asc_nulls_first())
        seated = work.save(asked.mapInArrow(_gibbs(parent, params, width), _seated(width)), "seated", rows=ROWS)
        heads, taken = seated.where("ctx is null"), seated.where("ctx is not null").select("w", "piece", "ctx", "n", *_numbered("t", width))
        grown = work.save(taken.groupBy("ctx").agg(F.array(*_by_sweep("t", width)).alias("ks")), "totals")
        for table in old:
            work.drop(table)
        old, seats = [seated, grown], taken.select("w", "piece", "ctx", "n")
        totals = contexts.where("back > 0").join(grown, "ctx").select("ctx", (F.col("tails") + _mean("ks", m)).alias("k"))
        rows = heads.select("w", "piece", "n", "singles", (_total("t", width) / m).alias("own"))
        large = heads.groupBy("w").agg(F.sum(_total("t", width) / m).alias("total"), F.count("*").alias("m")).where("m > 1").select("w", "total")
        # A word in pieces has the mean of its pieces' tables in the parent.
        by_word = heads.groupBy("w").agg(*_by_sweep("t", width), *_by_sweep("tops", width, F.avg))
        sums = by_word.agg(*_by_sweep("t", width), *_by_sweep("tops", width)).first()
        own, tops = ([(sums[y] or 0.0) * width / m for y in _numbered(x, width)] for x in ("t", "tops"))
        sweeps = [Parent(n["u1"] + o, n["lone"] + t, n["words"], inner, outer, params.strength) for o, t in zip(own, tops)]
        mean = lambda x: sum(getattr(p, x) for p in sweeps) / width
        parent = Parent(mean("customers"), mean("tables"), n["words"], inner, outer, params.strength)

    sampled = heads.groupBy("w").agg(
        F.first("n").alias("c"), F.array(*(F.first("singles") + x for x in _by_sweep("t", m))).alias("above"), F.array(*_by_sweep("tops", m, F.avg)).alias("tops")
    )
    one = F.array(*[F.lit(1.0)] * m)
    per_word = sampled.unionByName(words.where(lone).select("w", F.col("n").alias("c"), one.alias("above"), one.alias("tops")))
    tables = contexts.join(grown, "ctx", "left").select(F.col("ctx").alias("w"), F.array(*(F.col("tails") + F.coalesce(F.col("ks")[i], F.lit(0.0)) for i in range(m))).alias("ks"))
    chance = reduce(lambda a, b: a + b, (p.chance(F.col("above")[i], F.col("tops")[i]) for i, p in enumerate(sweeps))) / m
    back = (params.strength + inner * _mean("ks", m)) / (params.strength + F.col("c"))
    known = work.save(per_word.join(tables, "w"), "known")
    summed = taken.select("w", "ctx", "n", _total("t", m).cast("long").alias("t"))
    once = told.mapInArrow(_once, "key long").select("key", F.lit(1 - inner).alias("v"))
    pairs = once.unionByName(summed.select(pair_key().alias("key"), (F.col("n") - inner * F.col("t") / m).alias("v")))
    return WordModel(known.select("*", chance.alias("p"), back.alias("back")), summed, pairs, Sweeps(sweeps), n["n"])


def fit(texts: DataFrame, work: Workspace, params: PitmanYor = PitmanYor()) -> WordModel:
    """Counts and seats the training texts (column text)."""
    rows = texts.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return _seat(_read(rows, work), work, params)


#: Kinds of fingerprints that a chunk asks the model for.
WORD, PAIR = 0, 1


def _wanted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in each_chunk(batches):
            for kind, keys in ((WORD, c.words), (PAIR, c.keys[c.told >= OFTEN])):
                rows = [(b, pack_sorted(keys[at])) for b, at in by_bucket(keys, buckets)]
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * n, pa.int32()), pa.array([b for b, _ in rows], pa.int32()), pa.array([c.number] * n, pa.int64()), pa.array([x for _, x in rows], pa.binary())],
                    ["kind", "bucket", "chunk", "keys"],
                )

    return run


def _answer(wanted: pa.Table, model: pa.Table) -> pa.Table:
    """The model's numbers at the place of every fingerprint asked for; zeros where it has none."""
    keys = model.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    values = model.column("value").combine_chunks().flatten().to_numpy().reshape(len(keys), -1)[order] if len(keys) else np.zeros((1, 0))
    answers = []
    for x in wanted.column("keys"):
        asked = unpack_sorted(x.as_py())
        if not len(keys):
            answers.append(pack(np.zeros(0)))
            continue
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        answers.append(pack(np.where((keys[at] == asked)[:, None], values[at], 0.0).T.ravel()))
    return pa.table({**{x: wanted.column(x) for x in ("kind", "bucket", "chunk")}, "answer": pa.array(answers, pa.binary())})


def _answers(answers: list[dict], kind: int, sizes: list[int], width: int) -> np.ndarray:
    """Numbers of all fingerprints of a kind, one line for each of the ``width`` numbers."""
    got = [unpack(x["answer"], np.float64) for x in sorted(answers, key=lambda x: x["bucket"]) if x["kind"] == kind]
    parts = [x.reshape(width, -1) if len(x) else np.zeros((width, n)) for x, n in zip(got, sizes)]
    return np.concatenate(parts, 1) if parts else np.zeros((width, 0))


def _scorer(sweeps: Sweeps, train_tokens: int, buckets: int):
    m, d, s = len(sweeps.parents), sweeps.discount, sweeps.strength

    def score(row: pa.Table, answers: pa.Table) -> pa.Table:
        c, told = Chunk(row.to_pylist()[0]), answers.to_pylist()
        often = c.told >= OFTEN
        cut = lambda keys: [at.stop - at.start for _, at in by_bucket(keys, buckets)]
        words = _answers(told, WORD, cut(c.words), 1 + 3 * m)
        count, above, tops, ks = words[0].copy(), words[1 : m + 1], words[m + 1 : 2 * m + 1], words[2 * m + 1 :]
        back = [(s + d * ks[i]) / (s + count) for i in range(m)]
        chance = [p.chance(above[i], tops[i]) for i, p in enumerate(sweeps.parents)]
        # Arrays of pairs are a task's largest; each goes as soon as it has been used.
        del words, above, tops, ks
        whole = np.where(c.told == ONCE, 1 - d, 0.0)
        seated = _answers(told, PAIR, cut(c.keys[often]), 2)
        whole[often] = seated[0] - d * seated[1] / m
        del seated, often, told
        w, ctx = c.pairs
        whole /= (s + count)[ctx]
        mixed = np.zeros(len(w))
        for x, y in zip(back, chance):
            mixed += x[ctx] * y[w]
        del w, ctx
        mixed /= m
        mixed += whole
        del whole
        scores = c.over_texts(np.log10(mixed, out=mixed))
        base = np.log10((count + 1) / (train_tokens + sweeps.words + 1))
        return pa.table({
            "doc_id": pa.array(c.ids, pa.int64()), "held_out": pa.array(c.held), "n_tokens": pa.array(c.sizes), "n_known": pa.array(c.over_words((count > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(c.ids), train_tokens, np.int64)), "base_score": pa.array(c.over_words(base)), "score": pa.array(scores),
        })

    return score


def score(texts: DataFrame, work: Workspace, params: PitmanYor, schema: str) -> DataFrame:
    """Scores of texts (doc_id, text, held_out); learns from those not held out."""
    told = _read(texts, work)
    model = _seat(told, work, params)
    asked = told.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, -(-asked // WANTED))
    wanted = told.mapInArrow(_wanted(buckets), "kind int, bucket int, chunk long, keys binary")
    words = model.words.select(F.lit(WORD).alias("kind"), F.col("w").alias("key"), F.concat(F.array(F.col("c").cast("double")), "above", "tops", "ks").alias("value"))
    pairs = model.seats.select(F.lit(PAIR).alias("kind"), pair_key().alias("key"), F.array(F.col("n").cast("double"), F.col("t").cast("double")).alias("value"))
    bucket = F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.lit(buckets).cast("long"), 32).cast("int")
    numbers = words.unionByName(pairs).withColumn("bucket", bucket)
    answers = wanted.groupBy("kind", "bucket").cogroup(numbers.groupBy("kind", "bucket")).applyInArrow(_answer, "kind int, bucket int, chunk long, answer binary")
    answers = work.save(answers, "answers")
    return told.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scorer(model.parent, model.train_tokens, buckets), schema)
