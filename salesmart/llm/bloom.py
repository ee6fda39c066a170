"""A Bloom filter of bounded size over a column of 64-bit hashes, built by tasks and broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

HASHES = 4
#: Cells per row, and the most cells (one bit each: 16 MB). Beyond that the filter lets more through.
CELLS_PER_ROW, MAX_CELLS = 16, 1 << 27
_SLICES = 64


def _cells(hashes: np.ndarray, n_cells: int) -> np.ndarray:
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(n_cells - 1)).astype(np.int64)


def filter_of(hashes: DataFrame, max_cells: int = MAX_CELLS):
    """The broadcast bits of a filter of the frame's only column."""
    n_cells = 1 << 12
    while n_cells < min(max_cells, CELLS_PER_ROW * hashes.count()):
        n_cells *= 2
    width = n_cells // _SLICES

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.unique(_cells(batch.column(0).to_numpy(), n_cells))
            at = np.searchsorted(cells, np.arange(_SLICES + 1) * width)
            some = np.flatnonzero(np.diff(at))
            own = [(cells[at[k] : at[k + 1]] - k * width).astype(np.uint32).tobytes() for k in some.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(own, pa.binary())], ["slice", "cells"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(k, np.zeros(width, bool))[np.frombuffer(cells, np.uint32)] = True
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([np.packbits(b, bitorder="little").tobytes() for b in held.values()], pa.binary())], ["slice", "bits"])

    bits = np.zeros(n_cells // 8, np.uint8)
    for row in hashes.mapInArrow(mark, "slice int, cells binary").repartition("slice").mapInArrow(fold, "slice int, bits binary").collect():
        bits[row.slice * width // 8 : (row.slice + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that the filter was not built from."""
    if not len(hashes):
        return np.zeros(0, bool)
    cells = _cells(hashes, 8 * len(bits))
    return ((bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1)
