"""Texts of an Arrow batch as one byte array, and word and span fingerprints over it.

A hash of a byte span is a polynomial modulo 2**64 read off a running sum, so the hashes of all words or all
k-grams of a slice cost a few array passes. ``mix`` spreads the bits; equal spans have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and where each row starts (one more for the end); NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES, most: int = 1 << 30) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of at most ``most`` rows with about ``size`` bytes of text: the rows, their bytes, their starts."""
    for batch in batches:
        data, at = texts(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = min(row + most, max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1))
            yield batch.slice(row, end - row), data[at[row] : at[end]], at[row : end + 1] - at[row]
            row = end


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def running(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums: entry i covers the first i bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))


def lower_latin(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case."""
    low = LOWER[data]
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    tail = data[at]
    low[at] = np.where((tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97), tail + 0x20, tail)
    return low


def words(data: np.ndarray, at: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes not in ``outside``, and the row of each; runs end with their row."""
    inside = ~outside[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    edges = at[(at > 0) & (at < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)
