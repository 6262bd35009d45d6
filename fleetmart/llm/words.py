"""Words and word windows of whole texts as flat numpy arrays, read straight from Arrow string buffers.

A word is a run of bytes other than space and the control characters 9 to 13; as these are ASCII, splitting UTF-8 bytes
splits the characters the same way. Word and window identity is a 64-bit fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words as a regular expression for Spark and for the checking database.
WORD = "[^\\x20\\x09-\\x0D]+"

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_BASE = 0xD1342543DE82EF95
#: Bytes worked on at once; one longer text is still taken whole.
SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``limit`` bytes together, or one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of every word, and the number of the first word of every text, closed by the total."""
    n = len(data)
    solid = _SOLID[data]
    edge = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    before[edge] = False
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    after[edge - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit value per word, taken from its bytes in steps of eight."""
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) * _BASE)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    todo, at, left = np.arange(len(starts)), starts, lengths
    while len(todo):
        part = eights[at]
        short = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
        part = (part << short) >> short
        out[todo] = mix(out[todo] * _BASE + part)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return _LOWER[data]


_INVERSE = np.uint64(pow(_WINDOW_BASE, -1, 1 << 64))


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of every run of ``length`` words in one sequence of word fingerprints, by their first word."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(h) - 1, _WINDOW_BASE, np.uint64))))
    down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, _INVERSE, np.uint64))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(h * up)))
    return mix((sums[length:] - sums[:n]) * down + np.uint64(length))


def each_slice(column: pa.Array, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, fingerprints, first word per text) for successive ranges of texts."""
    data, offsets = flat(column)
    for i, j in slices(offsets):
        part = data[offsets[i] : offsets[j]]
        if lower:
            part = lowered(part)
        starts, ends, first = spans(part, offsets[i : j + 1] - offsets[i])
        yield i, j, fingerprints(part, starts, ends), first
