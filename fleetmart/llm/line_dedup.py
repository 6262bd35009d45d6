"""Lines that many documents hold, found with two Bloom filters.

The first pass puts the fingerprint of every line into a filter of what was seen once and, where it was there already,
into a filter of what was seen twice. Only lines that the second filter knows are suspected; they alone are shuffled, with
their text, to be counted exactly. Documents are then met again only for the numbers of the lines that go.

The filters have a bounded size. Beyond it they let more lines through, which are shuffled for nothing; the exact count
makes the result the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm import bloom
from fleetmart.llm.store import Workspace
from fleetmart.llm.words import _SOLID, fingerprints, flat, lowered, slices

NEWLINE = 10
_SHORT_RUN = 32


@dataclass(frozen=True)
class LineDedup:
    """Parameters."""

    #: Documents that must hold a line before it goes; at least 2.
    documents: int = 10
    #: Code points a line must have.
    least_chars: int = 1
    #: Whether the first document keeps a repeated line, at its first place there.
    keep_first: bool = False
    #: Bits of a filter per line, and of a filter at most (64 MB).
    bits_per_line: int = 16
    most_bits: int = 1 << 29


def lines(part: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of every line without its end, and the number of the first line of every text."""
    breaks = np.flatnonzero(part == NEWLINE)
    starts = np.sort(np.concatenate((edges[:-1], breaks + 1)))
    ends = np.sort(np.concatenate((breaks, edges[1:])))
    per_text = np.searchsorted(breaks, edges[1:]) - np.searchsorted(breaks, edges[:-1]) + 1
    return starts, ends, np.concatenate(([0], np.cumsum(per_text)))


def stripped(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges without white space at both ends; a blank line becomes empty."""
    first, last = starts.copy(), ends.copy()
    for edge, step, behind in ((first, 1, 0), (last, -1, -1)):
        todo = np.flatnonzero(first < last)
        # Runs of white space are short; a long one is searched as a whole.
        for _ in range(_SHORT_RUN):
            todo = todo[~_SOLID[part[edge[todo] + behind]]]
            edge[todo] += step
            todo = todo[first[todo] < last[todo]]
            if not len(todo):
                break
        for k in todo:
            solid = np.flatnonzero(_SOLID[part[first[k] : last[k]]])
            first[k], last[k] = (first[k] + solid[0], first[k] + solid[-1] + 1) if len(solid) else (first[k], first[k])
    return first, last


def _keys(column: pa.Array, least_chars: int):
    """(i, bytes, start, end, document, line, fingerprint) of the keys in successive ranges of texts; one entry per document and key,
    at the key's first line, and the lines of all entries as (entry, line)."""
    data, offsets = flat(column)
    for i, j in slices(offsets):
        part = lowered(data[offsets[i] : offsets[j]])
        starts, ends, first = lines(part, offsets[i : j + 1] - offsets[i])
        starts, ends = stripped(part, starts, ends)
        long_enough = ends > starts
        if least_chars > 1:
            chars = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
            long_enough &= chars[ends] - chars[starts] >= least_chars
        some = np.flatnonzero(long_enough)
        if not len(some):
            continue
        document = np.repeat(np.arange(j - i), np.diff(first))[some]
        h = fingerprints(part, starts[some], ends[some])
        order = np.lexsort((some, h, document))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (document[order][1:] != document[order][:-1])
        heads = order[new]
        yield i, part, starts[some][heads], ends[some][heads], document[heads], h[heads], np.flatnonzero(new), (some - first[document])[order]


def _filter_maker(least_chars: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from bloom.gathered_parts((x[5] for batch in batches for x in _keys(batch.column("text"), least_chars)), bits)

    return run


def _cut_bytes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte ranges as strings."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(part[at].tobytes())).cast(pa.string())


def _suspects(least_chars: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text_hash")
            for i, part, starts, ends, document, h, heads, places in _keys(batch.column("text"), least_chars):
                hit = np.flatnonzero(known.has(h))
                if not len(hit):
                    continue
                sizes = np.diff(np.append(heads, len(places)))[hit]
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                at = np.arange(offsets[-1]) + np.repeat(heads[hit] - offsets[:-1], sizes)
                rows = pa.array(i + document[hit])
                numbers = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(places[at].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([_cut_bytes(part, starts[hit], ends[hit]), ids.take(rows), texts.take(rows), numbers], ["key", "doc_id", "text_hash", "lines"])

    return run


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = batch.column("gone")
        sizes = np.where(gone.is_valid().to_numpy(zero_copy_only=False), np.nan_to_num(gone.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(int)
        owner, number = np.repeat(np.arange(len(gone)), sizes), gone.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        data, offsets = flat(batch.column("text"))
        n_lines, n_dropped, kept_sizes, kept_bytes = [], [], [], []
        for i, j in slices(offsets):
            part, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, first = lines(part, edges)
            stays = np.ones(len(starts), bool)
            mine = (owner >= i) & (owner < j)
            stays[first[owner[mine] - i] + number[mine]] = False
            document = np.repeat(np.arange(j - i), np.diff(first))
            n_lines.append(np.diff(first))
            n_dropped.append(np.bincount(document[~stays], minlength=j - i))
            kept = np.flatnonzero(stays)
            again = np.zeros(len(kept), np.int64)
            again[1:] = document[kept][1:] == document[kept][:-1]
            # The line end before a line that is not the first kept one stays with it.
            change = np.zeros(len(part) + 1, np.int64)
            np.add.at(change, starts[kept] - again, 1)
            np.add.at(change, ends[kept], -1)
            stay = np.cumsum(change[:-1]) > 0
            total = np.concatenate(([0], np.cumsum(stay)))
            kept_sizes.append(total[edges[1:]] - total[edges[:-1]])
            kept_bytes.append(part[stay])
        if not n_lines:
            continue
        ends = np.concatenate(([0], np.cumsum(np.concatenate(kept_sizes))))
        text = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(np.concatenate(kept_bytes).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(n_lines).astype(np.int64)), pa.array(np.concatenate(n_dropped).astype(np.int64)), text.cast(pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_text"],
        )


def _line_count(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def remove_repeated_lines(docs: DataFrame, params: LineDedup = LineDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text), one row per row of ``docs``.

    Texts are split at \\n. The key of a line is the line without white space at both ends, A-Z in lower case. A key of
    enough code points that enough rows hold loses its lines everywhere; with ``keep_first`` the row with the least id
    keeps the first of them. The other lines stay as they are, joined by \\n.

    A null or empty text is one empty line. Every row is a document: rows that repeat an id count as several, and with
    ``keep_first`` those that share the least id all keep the line, as do, if no other row has the line, rows without an
    id. An empty table gives an empty result; further columns are not read.
    """
    if params.documents < 2:
        raise ValueError("a line must be in two documents at least")
    spark = docs.sparkSession
    work = Workspace(spark, "lines")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = texts.agg(F.sum(_line_count(F.col("text")))).first()[0] or 0
    bits = bloom.filter_bits(total, params.bits_per_line, params.most_bits)
    twice = bloom.merged(texts.select("text").mapInArrow(_filter_maker(params.least_chars, bits), bloom.PARTS), bits, work, "twice")
    shared = spark.sparkContext.broadcast(twice)

    marked = texts.withColumn("text_hash", F.xxhash64("text"))
    suspects = marked.mapInArrow(_suspects(params.least_chars, shared), "key string, doc_id long, text_hash long, lines array<int>")
    suspects = work.save(suspects, "suspects")
    counts = suspects.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    repeated = work.save(counts.where(F.col("n") >= params.documents).select("key", "first_doc"), "repeated")
    gone = F.col("lines")
    if params.keep_first:
        gone = F.when(F.col("doc_id").eqNullSafe(F.col("first_doc")), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).otherwise(gone)
    hits = suspects.join(repeated, "key").select("doc_id", "text_hash", gone.alias("lines"))
    # Equal rows have equal lists, so a line may be named several times.
    gone = work.save(hits.groupBy("doc_id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("gone")), "gone")
    work.drop(suspects)
    told = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")
    met = marked.join(told, (F.col("text_hash") == F.col("gone_hash")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
    return met.select("doc_id", "text", "gone").mapInArrow(_cutter, "doc_id long, n_lines long, n_dropped long, kept_text string")
