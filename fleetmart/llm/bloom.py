"""Bloom filters of a bounded size over 64-bit fingerprints, built in parts by tasks and merged shard by shard.

A filter is a run of bits, cut into shards. A task hands on the set bits of the shards it touched, as places while they
are few and as a bitmap when they are many. Parts of a shard are merged a bounded number at a time. A filter never
misses a key; what it lets through by chance only costs work, since its users confirm exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.store import Workspace
from fleetmart.llm.words import mix

SHARD = 1 << 22
_SEGMENT = 1 << 16
#: Keys gathered by a task before it hands on its parts, and parts of a shard merged at once.
GATHERED, FAN = 2_000_000, 64
PARTS = "shard int, salt long, once binary, twice binary"


def filter_bits(keys: int, per_key: int = 16, most: int = 1 << 29) -> int:
    """Bits of a filter for so many keys, a power of two between 2^16 and ``most``."""
    bits = 1 << 16
    while bits < min(keys * per_key, most):
        bits *= 2
    return bits


def places(h: np.ndarray, bits: int, hashes: int = 3) -> np.ndarray:
    """(key, hash) bit numbers of fingerprints."""
    step = mix(h) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(hashes)], 1)


def _encode(at: np.ndarray, width: int) -> bytes:
    """Set bits of a shard, by rising place: counts per segment and 16-bit places, or a bitmap if that is shorter."""
    segments = -(-width // _SEGMENT)
    if 2 * len(at) + 4 * segments < width // 8:
        counts = np.bincount(at >> 16, minlength=segments).astype("<u4")
        return b"p" + counts.tobytes() + (at & 0xFFFF).astype("<u2").tobytes()
    bitmap = np.zeros(width, bool)
    bitmap[at] = True
    return b"b" + np.packbits(bitmap, bitorder="little").tobytes()


def _decode(payload: bytes, width: int) -> np.ndarray:
    """The shard's bits as booleans."""
    if payload[:1] == b"b":
        return np.unpackbits(np.frombuffer(payload, np.uint8, offset=1), count=width, bitorder="little").view(bool)
    segments = -(-width // _SEGMENT)
    counts = np.frombuffer(payload, "<u4", segments, 1)
    low = np.frombuffer(payload, "<u2", offset=1 + 4 * segments).astype(np.int64)
    out = np.zeros(width, bool)
    out[np.repeat(np.arange(segments) << 16, counts) + low] = True
    return out


def parts(keys: np.ndarray, twice: np.ndarray, bits: int) -> pa.RecordBatch:
    """Parts of the filters of different keys; ``twice`` marks those already seen more than once."""
    width = min(bits, SHARD)
    sets = [np.unique(places(k, bits).ravel()).astype(np.int64) for k in (keys, keys[twice])]
    shards = np.unique(sets[0] // width)
    out: list[list] = [[], []]
    for column, at in zip(out, sets):
        lo, hi = np.searchsorted(at, shards * width), np.searchsorted(at, (shards + 1) * width)
        column += [_encode(at[i:j] - s * width, width) for s, i, j in zip(shards, lo, hi)]
    salt = np.full(len(shards), int(keys.min() >> np.uint64(1)) if len(keys) else 0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array(salt), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["shard", "salt", "once", "twice"])


def gathered_parts(found: Iterator[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Parts of a stream of fingerprint arrays; a key counts once for every time it occurs."""
    held: list[np.ndarray] = []
    size = 0
    for h in found:
        held.append(h)
        size += len(h)
        if size >= GATHERED:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            yield parts(keys, n > 1, bits)
            held, size = [], 0
    if size:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        yield parts(keys, n > 1, bits)


def _merger(bits: int):
    width = min(bits, SHARD)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        once, twice = np.zeros(width, bool), np.zeros(width, bool)
        for a, b in zip(rows.column("once"), rows.column("twice")):
            new = _decode(a.as_py(), width)
            twice |= _decode(b.as_py(), width) | (once & new)
            once |= new
        salt = min(rows.column("salt").to_pylist())
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([salt], pa.int64()),
            "once": pa.array([_encode(np.flatnonzero(once), width)], pa.binary()), "twice": pa.array([_encode(np.flatnonzero(twice), width)], pa.binary()),
        })

    return merge


class BloomFilter:
    """A merged filter: its bits as bytes, of a size fixed beforehand."""

    def __init__(self, bits: int):
        self.bits, self.data = bits, np.zeros(bits // 8, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = places(h, self.bits)
        out = np.ones(len(h), bool)
        for k in range(at.shape[1]):
            out &= (self.data[at[:, k] >> np.uint64(3)] >> (at[:, k] & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def merged(partial: DataFrame, bits: int, work: Workspace, which: str) -> BloomFilter:
    """The ``once`` or ``twice`` filter of all parts (columns of ``PARTS``). What reaches the driver is the filter, ``bits`` long."""
    saved = work.save(partial, "parts")
    while True:
        most = saved.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        salted = saved.groupBy("shard", F.pmod(F.xxhash64("salt"), F.lit(-(-most // FAN) or 1)).alias("part"))
        last, before = most <= FAN, saved
        saved = work.save(salted.applyInArrow(_merger(bits), PARTS), "merged")
        work.drop(before)
        if last:
            break
    out, width = BloomFilter(bits), min(bits, SHARD)
    for row in saved.select("shard", which).toLocalIterator():
        at = row["shard"] * (width // 8)
        out.data[at : at + width // 8] = np.packbits(_decode(bytes(row[which]), width), bitorder="little")
    work.drop(saved)
    return out
