"""Numpy helpers on the raw buffers of Arrow string columns. Used inside tasks only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# [\x20\x09-\x0D]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (
    np.arange(1, 257, dtype=np.uint64) << np.uint64(29)
)
_POWERS = np.ones(1, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        size = 1 << int(n).bit_length()
        _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, _ODD))])
    return _POWERS


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets from 0; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 21):
    """Consecutive row ranges of about ``limit`` bytes, so that temporary arrays stay small."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 offsets of the rows' words."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.concatenate([[False], solid[:-1]]) & ~edge[:-1]
    after = np.concatenate([solid[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; only A-Z count as lower case."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    powers = _powers(int(lengths.max()) + 1)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    chars = data[place + np.repeat(starts, lengths)]
    return mix(np.add.reduceat(_BYTE[LOWER[chars]] * powers[place], first) + lengths.astype(np.uint64))


def shingle_sets(column, n: int):
    """For each row its sorted distinct ``n``-word shingles as 64-bit hashes.

    A row with fewer words has its whole sequence as the one shingle, a row without words none.
    """
    data, offsets = buffers(column)
    for first, last in slices(offsets):
        part = data[offsets[first] : offsets[last]]
        starts, ends, bounds = words(part, offsets[first : last + 1] - offsets[first])
        hashes = word_hashes(part, starts, ends)
        rolled = hashes.copy()
        for k in range(1, min(n, len(hashes))):
            rolled[:-k] = rolled[:-k] * _ODD + hashes[k:]
        rolled = mix(rolled)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= n:
                yield np.unique(rolled[lo : hi - n + 1])
            elif hi > lo:
                whole = np.uint64(hi - lo)
                for h in hashes[lo:hi]:
                    whole = np.uint64((int(whole) * int(_ODD) + int(h)) & 0xFFFFFFFFFFFFFFFF)
                yield mix(np.array([whole]))
            else:
                yield np.empty(0, np.uint64)
