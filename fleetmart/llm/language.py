"""Language of a text by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes. The code length of a byte is exact: a byte seen behind
the longest known context costs by its share of n + q (n bytes, q different ones, seen there); for the others the
context gives the escape share q / (n + q), dealt out as the next shorter context deals out the bytes not seen. Below
the empty context all bytes are equal. All 256 bytes are symbols. Statistics are frozen after training, so the code length
of a whole text is a sum of table entries, and the language with the shortest code is predicted.

The tables are sparse: per order the contexts and the bytes behind them that some language has shown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.store import Workspace
from fleetmart.llm.words import flat, lowered, slices

UNKNOWN = "und"
_PAD = 10


@dataclass(frozen=True)
class LanguageModel:
    """Training parameters."""

    #: Training text per language, in bytes: a bounded sample of the labelled rows, chosen by the hash of the id.
    bytes_per_language: int = 4_000_000


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Every byte with its three predecessors as one number; places before a text count as line ends."""
    n = len(data)
    out = data.astype(np.uint32)
    starts = offsets[:-1]
    for k in (1, 2, 3):
        back = np.full(n, _PAD, np.uint8)
        back[k:] = data[:-k]
        for d in range(k):
            at = starts + d
            back[at[at < np.minimum(offsets[1:], n)]] = _PAD
        out |= back.astype(np.uint32) << np.uint32(8 * k)
    return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = batch.column("lang").to_numpy(zero_copy_only=False)
        for language in sorted(set(languages)):
            data, offsets = flat(batch.column("text").filter(pa.array(languages == language)))
            if len(data):
                grams, counts = np.unique(_grams(lowered(data), offsets), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"]
                )


class Index:
    """Places of 32-bit keys: a hash table a quarter full, probed for many keys at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint32)
        self.width = max(4, int(4 * len(keys)).bit_length())
        self.table = np.full(1 << self.width, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._slots(self.keys)
        while len(todo):
            free = np.flatnonzero(self.table[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            self.table[at[free[first]]] = todo[free[first]]
            left = self.table[at] != todo
            todo, at = todo[left], self._next(at[left])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.width)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.width) - 1)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of every key, -1 for those that are not there."""
        at = self._slots(wanted)
        out = self.table[at]
        other = np.flatnonzero((out >= 0) & (self.keys[out] != wanted)) if len(self.keys) else np.zeros(0, np.int64)
        at = at[other]
        while len(other):
            at = self._next(at)
            out[other] = got = self.table[at]
            wrong = (got >= 0) & (self.keys[got] != wanted[other])
            other, at = other[wrong], at[wrong]
        return out


@dataclass
class Order:
    """Contexts of one length. A key holds the byte lowest, the byte before it above that, and so on."""

    grams: Index
    #: (gram, language): bits of its last byte behind its context.
    bits: np.ndarray
    contexts: Index
    #: (context, language): bits of the escape to the next shorter context, 0 where the language has not shown the context.
    escape: np.ndarray


@dataclass
class ContextTrees:
    """Frozen code lengths of all languages, by length of the context."""

    languages: list[str]
    orders: list[Order]

    @staticmethod
    def fit(languages: list[str], which: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> ContextTrees:
        n, orders = len(languages), []
        shorter_keys = shorter = None
        for k in range(4):
            keys, place = np.unique(grams & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            seen = np.bincount(place * n + which, counts, len(keys) * n).reshape(-1, n)
            contexts, behind = np.unique(keys >> 8, return_inverse=True)
            below = np.full((len(keys), n), 1 / 256) if k == 0 else shorter[np.searchsorted(shorter_keys, keys & ((1 << 8 * k) - 1))]
            # Sums over the bytes of a context; the keys are in the order of their contexts.
            edges = np.searchsorted(behind, np.arange(len(contexts)))
            total, kinds, taken = (np.add.reduceat(x, edges) for x in (seen, (seen > 0).astype(float), np.where(seen > 0, below, 0.0)))
            left = np.where(kinds < 256, np.maximum(1 - taken, 1e-300), 1.0)
            escape = np.where(kinds < 256, kinds, 0.0)
            with np.errstate(invalid="ignore", divide="ignore"):
                rest = escape / (total + escape) / left
                share = np.where(seen > 0, seen / (total + escape)[behind], np.where(total[behind] > 0, rest[behind] * below, below))
                bits = np.where((total > 0) & (escape > 0), -np.log2(np.maximum(rest, 1e-300)), 0.0)
            orders.append(Order(Index(keys), -np.log2(np.maximum(share, 1e-300)).astype(np.float32), Index(contexts), bits.astype(np.float32)))
            shorter_keys, shorter = keys, share
        return ContextTrees(languages, orders)

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """(place, language) bits of every byte behind its three predecessors."""
        out = np.zeros((len(grams), len(self.languages)), np.float32)
        left = np.arange(len(grams))
        for k in (3, 2, 1, 0):
            order, keys = self.orders[k], grams[left] & np.uint32((1 << 8 * (k + 1)) - 1)
            at = order.grams.find(keys)
            found = at >= 0
            out[left[found]] += order.bits[at[found]]
            left, keys = left[~found], keys[~found]
            if not len(left):
                return out
            at = order.contexts.find(keys >> np.uint32(8))
            known = at >= 0
            out[left[known]] += order.escape[at[known]]
        out[left] += 8
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(text, language) bits of whole lower-cased texts."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        if len(data):
            full = np.flatnonzero(np.diff(offsets) > 0)
            out[full] = np.add.reduceat(self.costs(_grams(data, offsets)), offsets[:-1][full], 0, dtype=np.float64)
        return out


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = np.concatenate(([0], np.cumsum((data >= 97) & (data <= 122))))
    out = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~out):
        part = data[offsets[i] : offsets[i + 1]]
        if (part >= 128).any():
            out[i] = any(c.isalpha() for c in part.tobytes().decode("utf-8", "replace"))
    return out


def _predictor(model: ContextTrees | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            data = lowered(data)
            best, score = [], []
            for i, j in slices(offsets, 1 << 18):
                part, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                if model is None:
                    best += [UNKNOWN] * (j - i)
                    score.append(np.zeros(j - i))
                    continue
                bits = model.code_lengths(part, edges)
                letters = _has_letter(part, edges)
                top = bits.argmin(1)
                weight = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                best += [model.languages[t] if ok else UNKNOWN for t, ok in zip(top, letters)]
                score.append(np.where(letters, 1 / weight, 0.0))
            values = np.concatenate(score) if score else np.zeros(0)
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(best, pa.string()), pa.array(values, pa.float64())], [*[batch.schema.names[i] for i in keep], "lang_pred", "score"]
            )

    return predict


def train(labelled: DataFrame, work: Workspace, params: LanguageModel = LanguageModel()) -> ContextTrees | None:
    """Context trees from rows with id, text and lang; None without any training text.

    Two numbers per language and the counted contexts of the bounded sample come to the driver.
    """
    # A row without an id is drawn by its text.
    hashed = labelled.withColumn("_hash", F.when(F.col("id").isNotNull(), F.xxhash64("id", F.lit("sample"))).otherwise(F.xxhash64("text", F.lit("sample"))))
    size = F.octet_length("text")
    sums = hashed.groupBy("lang").agg(F.sum(size).alias("bytes"), F.min(F.when(size > 0, F.col("_hash"))).alias("_least")).where("bytes > 0")
    # Written first, so its size is known before the join and a small one does not make the texts move.
    sums = work.save(sums, "languages")
    share = F.least(F.lit(1.0), F.lit(float(params.bytes_per_language)) / F.col("bytes"))
    # The least hash of a language is always taken, so a language of few and very long texts is learned too.
    drawn = hashed.join(sums, "lang").where((F.pmod("_hash", F.lit(1_000_000)) < share * 1_000_000) | (F.col("_hash") == F.col("_least")))
    counted = drawn.select("lang", "text").mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return None
    languages = sorted(counted["lang"].unique())
    which = counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    return ContextTrees.fit(languages, which, counted["gram"].to_numpy(), counted["n"].to_numpy())


def predict_language(docs: DataFrame, keep: list[str], train_on: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", params: LanguageModel = LanguageModel()) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score, one row per row.

    Learns from the rows that ``train_on`` selects and that have a text and a language. lang_pred is ``und`` and the
    score 0 where the text is null or has no letter, and everywhere if there was nothing to learn from. Otherwise the
    score is the share of the predicted language when all are equally likely before; ties go to the smaller name.
    Whole texts are read, also very long ones. Repeated rows are predicted alike; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "language")
    labelled = docs.where(train_on & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = train(labelled, work, params)
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["kept"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predictor(model), schema).select("kept.*", "lang_pred", "score")
