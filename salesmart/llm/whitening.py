"""Whitening of embeddings by refined principal components.

Entries become whole numbers, so counts, sums and products add up exactly whatever the order of the tasks, and the
covariance is the exact one, rounded once. Its eigenvectors are found in float32 and then corrected in the widest float
of the machine: each round measures how far the vectors are from orthogonal and from diagonalising the matrix, and
one matrix product with the correction (Ogita and Aishima) squares the error. Vectors whose eigenvalues lie closer than the
error can tell apart are first made orthogonal only and then turned among themselves by the eigenvectors of their own
small matrix, shifted by their mean eigenvalue.

Tasks hold one block of rows and one square matrix of the dimensions; only such matrices reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An entry ``c`` becomes ``floor(SCALE * c) + OFFSET``; entries of which that is no exact integer in a double are unusable.
SCALE, OFFSET, LARGEST = 64, 1_000_000, 1 << 53
COMPONENTS = 32
#: Rounds of correction at most, and the largest change after which the next one is below the precision: the error is
#: squared in each, so a few are enough.
ROUNDS, SMALL_CHANGE = 10, 1e-11
_LIMB = 26
_BLOCK_ROWS = 2048
_WIDE = np.longdouble
_TOTAL = pa.decimal128(38, 0)


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, and all entries finite numbers that become exact integers."""
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c) * SCALE < LARGEST - OFFSET, F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & inside


def _usable_rows(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """Id and vector (as doubles, called ``v``) of the usable rows of the most frequent length, and that length."""
    rows = vectors.select(F.col(id_column), F.col(vector_column).cast("array<double>").alias("v")).where(usable(F.col("v")))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (most.d if most else 0)), most.d if most else 0


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some rows, and their entries as whole numbers."""
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK_ROWS):
            rows = batch.slice(start, _BLOCK_ROWS)
            entries = rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield rows, np.floor(SCALE * entries).astype(np.int64) + OFFSET


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for _, x in _blocks(batches, d):
            n += len(x)
            high += (x >> _LIMB).sum(axis=0)
            low += (x & ((1 << _LIMB) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = rows.select("v").mapInArrow(run, "i int, n long, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), total("high"), total("low")).collect()
    sums = {r.i: (int(r.high) << _LIMB) + int(r.low) for r in found}
    return found[0].n, [sums[i] for i in range(d)]


def _product(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` in Python integers. Float products are exact as long as every sum stays below 2**53."""
    most = int(np.abs(y).max(initial=0))
    if most >= 1 << _LIMB:
        wide = y.astype(object)
        return wide.T @ wide
    step = max(1, (1 << 53) // max(1, most * most))
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for start in range(0, len(y), step):
        part = y[start : start + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _products(rows: DataFrame, d: int, shift: np.ndarray) -> list[list[int]]:
    """Exact sums of products of the entries less ``shift``, for each pair of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for _, x in _blocks(batches, d):
            total = total + _product(x - shift)
        for i in range(d):
            own = pa.array([Decimal(int(v)) for v in total[i, i:]], _TOTAL)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d - i, i), pa.int32()), pa.array(np.arange(i, d), pa.int32()), own], ["i", "j", "p"])

    out = [[0] * d for _ in range(d)]
    for r in rows.select("v").mapInArrow(run, "i int, j int, p decimal(38,0)").groupBy("i", "j").agg(F.sum("p").alias("p")).collect():
        out[r.i][r.j] = out[r.j][r.i] = int(r.p)
    return out


def _runs(values: np.ndarray, gap) -> list[np.ndarray]:
    """Positions of values that follow each other closer than ``gap``, where more than one does."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One round: the better vectors, the eigenvalues before it, the distance under which two of them are not told apart, and the
    largest change. Vectors that are not told apart are only made orthogonal."""
    off = np.eye(len(a), dtype=_WIDE) - x.T @ x
    inner = x.T @ a @ x
    values = np.diag(inner) / (1 - np.diag(off))
    gap = 2 * (np.linalg.norm(inner - np.diag(values)) + np.abs(values).max() * np.linalg.norm(off))
    gap = max(gap, 4 * len(a) * np.finfo(_WIDE).eps * np.abs(values).max())  # what rounding alone makes of equal ones
    apart = values[None, :] - values[:, None]
    near = np.abs(apart) <= gap
    change = np.where(near, off / 2, (inner + values[None, :] * off) / np.where(near, 1, apart))
    return x + x @ change, values, gap, float(np.abs(change).max())


def _orthogonal(x: np.ndarray) -> np.ndarray:
    """The vectors made orthogonal and of unit length, all changed alike; the error is squared in each of the steps."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=_WIDE) - x.T @ x) / 2
    return x


def _turned(a: np.ndarray, part: np.ndarray, middle) -> np.ndarray:
    """The vectors of a cluster, turned among themselves by the eigenvectors of their own matrix less ``middle``."""
    small = part.T @ (a @ part - middle * part)
    scale = np.abs(small).max()
    return part @ np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))[1].astype(_WIDE) if scale > 0 else part


def refined_eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of wide floats, as columns.

    The largest entry of each vector is positive.
    """
    size = max(np.abs(matrix).max(initial=0), np.finfo(_WIDE).tiny)
    a = (matrix / size).astype(_WIDE)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_WIDE)
    settled = False
    for _ in range(ROUNDS):
        x, values, gap, step = _corrected(a, x)
        clusters = _runs(values, gap)
        if step < SMALL_CHANGE and (settled or not clusters):
            break
        settled = step < SMALL_CHANGE
        for own in clusters:
            x[:, own] = _turned(a, x[:, own], values[own].mean())
    for _ in range(2):  # turning is done in doubles, so the last rounds are corrections
        x = _corrected(a, _orthogonal(x))[0]
    x = _orthogonal(x)
    values = np.diag(x.T @ a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    largest = x[np.abs(x).argmax(axis=0), np.arange(len(a))]
    return values[order] * size, x * np.where(largest < 0, -1, 1)


@dataclass(frozen=True)
class Whitener:
    """What whitens a row: sums of all rows, the integer nearest to their mean, and the components as columns.

    ``values`` are the eigenvalues; where one is zero to rounding the component has no scale (``has_scale`` false).
    """

    n: int
    sums: list[int]
    shift: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    has_scale: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The components of rows, NaN where a component has no scale."""
        rest = np.array([s - self.n * int(h) for s, h in zip(self.sums, self.shift, strict=True)], _WIDE) / self.n
        scale = np.where(self.has_scale, np.sqrt(np.where(self.has_scale, self.values, 1)), np.nan)
        return ((x - self.shift) - rest.astype(np.float64)) @ (self.vectors / scale).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Sum over dimensions of ``(n * x - sum) ** 2`` of each row, exact."""
        y, n = x - self.shift, self.n
        rest = [s - n * int(h) for s, h in zip(self.sums, self.shift, strict=True)]
        bound = y.shape[1] * int(np.abs(y).max(initial=0)) * max(int(np.abs(y).max(initial=0)), max(map(abs, rest)))
        y, r = (y, np.array(rest, np.int64)) if bound < 1 << 62 else (y.astype(object), np.array(rest, object))
        squares, mixed, fixed = (y * y).sum(axis=1).tolist(), (y @ r).tolist(), sum(v * v for v in rest)
        return [Decimal(n * n * a - 2 * n * b + fixed) for a, b in zip(squares, mixed, strict=True)]


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of rows that ``_usable_rows`` gave; None where there are none."""
    if not d:
        return None
    n, sums = _sums(rows, d)
    shift = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(h) for s, h in zip(sums, shift, strict=True)]
    products = _products(rows, d, shift)
    exact = [[n * products[i][j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]  # n * n times the covariance
    square = _WIDE(n) * _WIDE(n)
    covariance = np.array([[_WIDE(v) for v in row] for row in exact], _WIDE) / square
    values, vectors = refined_eigenvectors(covariance)
    has_scale = values > values[0] * len(values) * _WIDE(2) ** -50
    keep = slice(0, components)
    trace = float(_WIDE(sum(exact[i][i] for i in range(d))) / square)
    return Whitener(n, sums, shift, values[keep], vectors[:, keep], trace, has_scale[keep])


def _identity_error(rows: DataFrame, d: int, model) -> float | None:
    """Largest entry, in absolute value, of the covariance of the whitened rows less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = int(model.value.has_scale.sum())
        total = np.zeros((k + 1, k))
        for _, x in _blocks(batches, d):
            w = model.value.whitened(x)[:, model.value.has_scale]
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "p"])

    k = int(model.value.has_scale.sum())
    if not k:
        return None
    total = np.zeros((k + 1, k))
    for r in rows.select("v").mapInArrow(run, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p")).collect():
        total[r.i, r.j] = r.p
    total /= model.value.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors that are NULL or empty, or hold NULL, NaN, infinite or larger entries than ``LARGEST / SCALE``, are dropped,
    and so are those of another length than the most frequent one (of equally frequent ones the longer).
    ``deviation`` is a decimal, as ``n`` squared outgrows a long. A component whose eigenvalue is zero to rounding has no scale:
    ``whitened`` is NULL there and ``identity_error`` leaves it out; without any variance ``explained`` and
    ``identity_error`` are NULL. Rows that repeat, and NULL ids, count and come out row by row. Other columns are not
    read. An empty table gives no rows.
    """
    rows, d = _usable_rows(vectors, id_column, vector_column)
    fitted = fit(rows, d, components)
    schema = f"`{id_column}` {dict(vectors.dtypes)[id_column]}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    model = vectors.sparkSession.sparkContext.broadcast(fitted)
    error = _identity_error(rows, d, model)
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k = len(m.values)
        share = [float(v) / m.trace if m.trace > 0 else None for v in m.values]
        for some, x in _blocks(batches, d):
            at = pa.array(np.repeat(np.arange(len(x)), k))
            w = m.whitened(x).ravel()
            yield pa.RecordBatch.from_arrays([
                some.column(id_column).take(at), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(x) * k, m.n), pa.int64()),
                pa.array(m.deviations(x), _TOTAL).take(at), pa.array(w, mask=np.isnan(w)), pa.array(share * len(x), pa.float64()), pa.array([error] * (len(x) * k), pa.float64())], names)

    return rows.mapInArrow(run, schema)
