"""Texts of an Arrow batch as one byte array, and rolling hashes over it.

The helpers work on slices of a batch of about `SLICE_BYTES`, so a task's memory
follows the slice (or the longest text), not the batch. Hashes are polynomials
modulo 2**64 over random byte codes, mixed at the end; `seed` gives independent
ones, and two of them together serve as a 128-bit key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    array = pc.fill_null(column, "").cast(pa.large_string())
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    start = 0
    while start < len(array):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(array))
        own = offsets[start : stop + 1]
        yield start, data[own[0] : own[-1]], own - own[0]
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=16)
def _codes(seed: int) -> tuple[np.ndarray, int, int]:
    random = np.random.Generator(np.random.PCG64(seed))
    table = random.integers(0, 2**64, 256, dtype=np.uint64)
    base = int(random.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
    return table, base, pow(base, -1, 2**64)


_powers_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    kept = _powers_kept.get(seed)
    if kept is None or len(kept[0]) < n:
        _, base, inverse = _codes(seed)
        size = max(n, SLICE_BYTES + 1)
        kept = []
        for factor in (base, inverse):
            powers = np.full(size, factor, dtype=np.uint64)
            powers[0] = 1
            kept.append(np.cumprod(powers, dtype=np.uint64))
        kept = tuple(kept)
        if size <= 4 * SLICE_BYTES:
            _powers_kept[seed] = kept
    return kept


class Prefixes:
    """Hash of any range of a byte array in constant time."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.powers, self.inverses = _powers(seed, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_codes(seed)[0][data] * self.powers[: len(data)], out=self.sums[1:])

    def range(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self.sums[stop] - self.sums[start]) * self.inverses[start]
        return mix(raw ^ (stop - start).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; other bytes as they are."""
    return _LOWER[data]


def spaces(data: np.ndarray) -> np.ndarray:
    """Where a byte is a space or one of the controls 9 to 13."""
    return _SPACE[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each maximal run of other bytes than white space; runs end at text ends."""
    inside = ~spaces(data)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    stop = np.flatnonzero(inside & (~after | first[1:])) + 1
    return start, stop


def words(data: np.ndarray, offsets: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word, and the place of each text's first word (one more at the end)."""
    start, stop = word_bounds(data, offsets)
    hashes = Prefixes(lowered(data), seed).range(start, stop)
    return hashes, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, splits: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and their splits by text.

    A text of fewer words, but at least one, has one shingle of all its words.
    """
    counts = np.diff(splits)
    long = np.maximum(counts - size + 1, 0)
    out_counts = np.where((counts > 0) & (counts < size), 1, long)
    out_splits = np.concatenate([[0], np.cumsum(out_counts)])
    begin = np.arange(out_splits[-1]) - np.repeat(out_splits[:-1], out_counts) + np.repeat(splits[:-1], out_counts)
    width = np.repeat(np.minimum(counts, size), out_counts)
    value = width.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    for j in range(size):
        term = np.where(j < width, padded[begin + j], np.uint64(0))
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + term)
    return value, out_splits
