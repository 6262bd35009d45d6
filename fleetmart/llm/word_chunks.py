"""Texts as chunks of numbered words, packed so that a word pair costs a few bytes on disk and in a shuffle.

A chunk holds some million tokens of successive texts of a task: its different words as sorted fingerprints, and the tokens
as places among them. Its different pairs follow from these at any time, in the order of their fingerprints. So an answer
about every pair or word of a chunk needs no key: it stands at the pair's place. Numbers are split into byte planes and
compressed; sorted fingerprints are stored by their differences.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from fleetmart.llm.pitman_yor import END, _tokens

#: Tokens of a chunk; a longer text is a chunk of its own.
CHUNK = 1_000_000

CHUNKS = "chunk long, ids array<long>, held array<boolean>, sizes array<long>, words binary, counts binary, tokens binary, n_tokens long, n_words long, trained long"


def pack(x: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return len(x).to_bytes(8, "little") + pa.Codec("zstd").compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * width, asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _rotated(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def _hashed(ctx: np.ndarray) -> np.ndarray:
    """xxhash64 of 64-bit numbers as Spark computes it."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = _rotated(ctx * p2, 31) * p1 ^ (p5 + np.uint64(50))
    h = _rotated(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def pair_keys(w: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of words behind contexts: ``w ^ xxhash64(ctx)``."""
    return w ^ _hashed(ctx)


def runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers starts."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Sorted fingerprints cut into ranges of equal width; empty ones are left out."""
    number = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    which, start = np.unique(number, return_index=True)
    for b, i, j in zip(which.tolist(), start.tolist(), [*start[1:].tolist(), len(keys)]):
        yield b, slice(i, j)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``CHUNKS`` from (doc_id, held_out, text)."""
    number, held = TaskContext.get().partitionId() << 32, []

    def row() -> pa.RecordBatch:
        tokens = np.concatenate([t for _, _, t, _ in held])
        flags = np.concatenate([f for _, f, _, _ in held])
        sizes = np.concatenate([s for _, _, _, s in held])
        words, place, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        # Frequent words get small numbers, which pack better.
        rank = np.empty(len(words), np.uint32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(words), dtype=np.uint32)
        values = {
            "chunk": number, "ids": pa.concat_arrays([x for x, _, _, _ in held]).to_pylist(), "held": flags.tolist(), "sizes": sizes.tolist(),
            "words": pack_sorted(words), "counts": pack(counts.astype(np.uint64)), "tokens": pack(rank[place]),
            "n_tokens": len(tokens), "n_words": len(words), "trained": int(sizes[~flags].sum()),
        }
        return pa.RecordBatch.from_pylist([values], SCHEMA)

    size = 0
    for batch in batches:
        ids, flags = batch.column("doc_id"), batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for i, j, t, first in _tokens(batch.column("text")):
            held.append((ids.slice(i, j - i), flags[i:j], t, np.diff(first)))
            size += len(t)
            if size >= CHUNK:
                yield row()
                number, held, size = number + 1, [], 0
    if held:
        yield row()


SCHEMA = pa.schema([
    ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())),
    ("words", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()), ("n_tokens", pa.int64()), ("n_words", pa.int64()), ("trained", pa.int64()),
])


class Chunk:
    """A chunk read back from its row."""

    def __init__(self, row: dict):
        self.number, self.ids = row["chunk"], row["ids"]
        self.held, self.sizes = np.array(row["held"], bool), np.array(row["sizes"], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        self.words = unpack_sorted(row["words"])
        order = np.argsort(-unpack(row["counts"], np.uint64).astype(np.int64), kind="stable")
        self.tokens = order[unpack(row["tokens"], np.uint32)]
        self.in_training = np.repeat(~self.held, self.sizes)
        self.told = unpack(row["told"], np.uint64) if row.get("told") is not None else None

    @cached_property
    def _codes(self) -> np.ndarray:
        """Word and context of every token in one number."""
        out = self.tokens * len(self.words)
        out[1:] += self.tokens[:-1]
        start = self.first[:-1]
        out[start] = self.tokens[start] * len(self.words) + np.searchsorted(self.words, END)
        return out

    @cached_property
    def _different(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, order, keys, code, trained): the run of every different pair among the sorted codes, and the pairs' order by
        fingerprint, in which the others are."""
        u = self._codes * 2 + self.in_training
        u.sort()
        start = runs(u >> 1)
        trained = np.add.reduceat(u & 1, start)
        code = u[start] >> 1
        del u
        w, ctx = np.divmod(code, len(self.words))
        keys = self.words[w] ^ _hashed(self.words)[ctx]
        del w, ctx
        order = np.argsort(keys)
        ordered = keys[order]
        if len(runs(ordered)) < len(ordered):
            # Pairs of one fingerprint stand in the same order on every machine.
            order = np.argsort(keys, kind="stable")
        return start, order, ordered, code[order], trained[order]

    @property
    def keys(self) -> np.ndarray:
        """Fingerprints of the different pairs, sorted; what follows is in this order."""
        return self._different[2]

    @property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of word and context among ``words``."""
        return np.divmod(self._different[3], len(self.words))

    @property
    def trained(self) -> np.ndarray:
        """Occurrences of the pairs in training texts."""
        return self._different[4]

    def over_texts(self, by_pair: np.ndarray) -> np.ndarray:
        """Sum per text of a value of its pairs."""
        start, order = self._different[:2]
        by_code = np.empty(len(order))
        by_code[order] = by_pair
        by_token = np.empty(len(self.tokens))
        # Sorted, the tokens of a pair stand together.
        by_token[np.argsort(self._codes)] = np.repeat(by_code, np.diff(start, append=len(by_token)))
        return np.add.reduceat(by_token, self.first[:-1])

    def over_words(self, by_word: np.ndarray) -> np.ndarray:
        """Sum per text of a value of its words."""
        return np.add.reduceat(by_word[self.tokens], self.first[:-1])


def each_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0])
