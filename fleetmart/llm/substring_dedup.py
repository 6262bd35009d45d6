"""Passages that repeat across documents, found by doubling the window length.

Level one looks at windows of half the length. Of the half windows inside each full window one is chosen, the one with
the least fingerprint, so two equal full windows choose equal half windows, and only about one half window in seven has
to be counted. A half window that occurs in one document alone rules out all full windows that chose it. Only the
others are extended to twice the length. Where several documents agree on the whole stretch of full windows that chose
one half window, the least of them stands for all: the others repeat it entirely. The full windows of what is left
are counted one by one. At the full length no candidate goes further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.store import Workspace
from fleetmart.llm.words import each_slice, flat, mix, slices, spans, windows

_STEP = 0xD1342543DE82EF95
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))
_NONE = np.iinfo(np.uint64).max


def _powers(base, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n - 1, 0), base, np.uint64))))


def _chosen(half: np.ndarray, valid: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, choice) of every full window: the leftmost least half window among the ``span`` it holds."""
    starts = np.flatnonzero(valid)
    if not len(starts):
        return starts, starts
    views = np.lib.stride_tricks.sliding_window_view(half, span)
    parts = [starts[k : k + 200_000] for k in range(0, len(starts), 200_000)]
    return starts, np.concatenate([views[p].argmin(1) + p for p in parts])


def _half_windows(length: int):
    half_length, span = length // 2, length - length // 2 + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, variants = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "variant"))
            for i, j, h, first in each_slice(batch.column("text"), lower=False):
                if len(h) < length:
                    continue
                lengths = np.diff(first)
                document = np.repeat(np.arange(j - i), lengths)
                half = windows(h, half_length)
                valid = np.zeros(len(h) - length + 1, bool)
                valid[:] = document[: len(valid)] == document[length - 1 :]
                starts, choice = _chosen(half, valid, span)
                if not len(starts):
                    continue
                # Full windows of one document that follow each other and chose the same half window are one stretch.
                new = np.ones(len(starts), bool)
                new[1:] = (choice[1:] != choice[:-1]) | (starts[1:] != starts[:-1] + 1)
                heads = np.flatnonzero(new)
                lo, hi = starts[heads], starts[np.concatenate((heads[1:], [len(starts)])) - 1]
                at = choice[heads]
                up, down = _powers(np.uint64(_STEP), len(h)), _powers(_BACK, len(h))
                sums = np.concatenate(([np.uint64(0)], np.cumsum(h * up)))
                whole = mix((sums[hi + length] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(4096) + (at - lo).astype(np.uint64))
                d = document[lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j][d]), pa.array(variants[i:j][d]), pa.array((lo - first[d]).astype(np.int32)), pa.array((hi - first[d]).astype(np.int32)),
                     pa.array(half[at].view(np.int64)), pa.array(whole.view(np.int64))],
                    ["doc_id", "variant", "lo", "hi", "half", "stretch"],
                )

    return find


def _ranges(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, hi) of a list column of structs; nulls are empty lists."""
    if column.null_count:
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(int)
    else:
        lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    pieces = column.flatten()
    return np.repeat(np.arange(len(column)), lengths), pieces.field("lo").to_numpy(zero_copy_only=False), pieces.field("hi").to_numpy(zero_copy_only=False)


def _full_windows(length: int):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, variants = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "variant"))
            row, lo, hi = _ranges(batch.column("ranges"))
            for i, j, h, first in each_slice(batch.column("text"), lower=False):
                mine = (row >= i) & (row < j)
                if not mine.any() or len(h) < length:
                    continue
                full = windows(h, length)
                n = (hi - lo)[mine] + 1
                base = np.repeat(first[row[mine] - i] + lo[mine], n)
                at = base + np.arange(len(base)) - np.repeat(np.cumsum(n) - n, n)
                owner = np.repeat(row[mine], n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full[at].view(np.int64)), pa.array(ids[owner]), pa.array(variants[owner]), pa.array((at - first[owner - i]).astype(np.int32))],
                    ["full", "doc_id", "variant", "start"],
                )

    return extend


def _cutter(length: int, layout: bool, carried: list[str]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lo, hi = _ranges(batch.column("ranges"))
            data, offsets = flat(batch.column("text"))
            n_words, n_removed, kept_sizes, kept_bytes = [], [], [], []
            for i, j in slices(offsets):
                part = data[offsets[i] : offsets[j]].copy()
                edges = offsets[i : j + 1] - offsets[i]
                starts, ends, first = spans(part, edges)
                change = np.zeros(len(starts) + 1, np.int64)
                mine = (row >= i) & (row < j)
                at = first[row[mine] - i]
                np.add.at(change, at + lo[mine], 1)
                np.add.at(change, at + hi[mine] + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                lengths = np.diff(first)
                document = np.repeat(np.arange(j - i), lengths)
                n_words.append(lengths)
                n_removed.append(np.bincount(document[gone], minlength=j - i))
                mask = np.zeros(len(part) + 1, np.int8)
                if layout:
                    # A removed word goes with the white space up to the next word or the end of its text.
                    stop = np.where(np.arange(len(starts)) + 1 < first[document + 1], np.append(starts[1:], 0), edges[document + 1]) if len(starts) else starts
                    mask[starts[gone]] += 1
                    np.add.at(mask, stop[gone], -1)
                    stay = np.cumsum(mask[:-1]) == 0
                else:
                    kept = np.flatnonzero(~gone)
                    mask[starts[kept]] = 1
                    np.add.at(mask, ends[kept], -1)
                    stay = np.cumsum(mask[:-1]) > 0
                    again = np.flatnonzero(document[kept][1:] == document[kept][:-1])
                    blank = ends[kept[again]]
                    part[blank] = 32
                    stay[blank] = True
                total = np.concatenate(([0], np.cumsum(stay)))
                kept_sizes.append(total[edges[1:]] - total[edges[:-1]])
                kept_bytes.append(part[stay])
            if not n_words:
                continue
            sizes = np.concatenate(([0], np.cumsum(np.concatenate(kept_sizes))))
            text = pa.LargeStringArray.from_buffers(len(sizes) - 1, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(np.concatenate(kept_bytes).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(n_words).astype(np.int64)), pa.array(np.concatenate(n_removed).astype(np.int64)), text.cast(pa.string()), *[batch.column(c) for c in carried]],
                ["doc_id", "n_words", "n_removed", "kept_text", *carried],
            )

    return cut


def _told_apart(texts: DataFrame, work: Workspace) -> DataFrame:
    """``texts`` with variant: 0, or the hash of the text where an id has several unlike texts."""
    hashed = texts.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("h"))
    several = work.save(hashed.groupBy("doc_id").agg(F.min("h").alias("h0"), F.max("h").alias("h1")).where("h0 <> h1").select(F.col("doc_id").alias("several")), "several")
    if several.isEmpty():
        return texts.withColumn("variant", F.lit(0).cast("long"))
    met = texts.join(several, F.col("doc_id") == F.col("several"), "left")
    return met.withColumn("variant", F.when(F.col("several").isNotNull() & F.col("text").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("several")


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", layout: bool = False, carry: Column | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), one row per row of ``docs``, and with ``carry`` that column as ``carried``.

    A word goes when a window of ``length`` words covers it whose word sequence also starts in a document with a smaller
    id. Windows are judged on the input. ``kept_text`` holds the kept words joined by one space, or, with ``layout``,
    the text as it was without the removed words and the white space behind them.

    A null or blank text has no words and an empty kept text; texts shorter than a window lose nothing. Rows without an
    id lose nothing and cause nothing. Rows that repeat an id, with the same text or another, are judged each by
    its own text and cause nothing for each other, as none has the smaller id. Further columns
    are not read; an empty table gives an empty result.
    """
    if length < 4 or length > 4096:
        raise ValueError("length must be between 4 and 4096 words")
    work = Workspace(docs.sparkSession, "doubling")
    more = [] if carry is None else ["carried"]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[carry.alias(c) for c in more])
    texts = _told_apart(texts, work)
    known = texts.where("doc_id is not null and text is not null").select("doc_id", "variant", "text")

    halves = work.save(known.mapInArrow(_half_windows(length), "doc_id long, variant long, lo int, hi int, half long, stretch long"), "halves")
    repeated = halves.groupBy("half").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).where("d0 < d1").select("half")
    # The small side of each join is written first: a join of two plain shuffles is one whose hot keys AQE can split.
    hits = work.save(halves.join(work.save(repeated, "repeated"), "half"), "hits")
    work.drop(halves)

    # A document may hold its stretch at several places; the least document keeps them all.
    least = work.save(hits.groupBy("half", "stretch").agg(F.min("doc_id").alias("least_doc")), "least")
    told = work.save(hits.join(least, ["half", "stretch"]), "told")
    work.drop(hits)
    copied = told.where("doc_id > least_doc").select("doc_id", "variant", "lo", "hi")
    first = told.where("doc_id = least_doc")
    open_halves = first.groupBy("half").agg(F.min("stretch").alias("s0"), F.max("stretch").alias("s1")).where("s0 <> s1").select("half")
    stretches = first.join(work.save(open_halves, "open"), "half").groupBy("doc_id", "variant").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    full = known.join(stretches, ["doc_id", "variant"]).select("doc_id", "variant", "text", "ranges").mapInArrow(_full_windows(length), "full long, doc_id long, variant long, start int")
    full = work.save(full, "full")
    source = full.groupBy("full").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).where("d0 < d1").select("full", "d0")
    later = full.join(work.save(source, "source"), "full").where("doc_id > d0").select("doc_id", "variant", F.col("start").alias("lo"), F.col("start").alias("hi"))

    gone = copied.unionByName(later).groupBy("doc_id", "variant").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    schema = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_text string")
    for c in more:
        schema = schema.add(c, texts.schema[c].dataType)
    return texts.join(gone, ["doc_id", "variant"], "left").select("doc_id", "text", "ranges", *more).mapInArrow(_cutter(length, layout, more), schema)
