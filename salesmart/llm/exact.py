"""Exact deduplication in two passes over digests, with a Bloom filter of possibly repeated ones between them.

Pass one marks the cells of each digest in two bit arrays, "seen" and "seen again"; the arrays of all tasks are
combined slice by slice. A digest that occurs twice has all its cells in the second array, so a row with a clear cell
there is the only one of its text and passes straight through. Only the other rows are shuffled; they are compared by
their whole SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm import arrays
from salesmart.llm.storage import unused, written
from salesmart.operators.joins import splittable_join

#: Cells for each row, and the largest filter (in cells; one bit each where it is broadcast: 8 MB). A table with more
#: rows than ``MAX_CELLS / CELLS_PER_ROW`` sends more unrepeated rows through the shuffle; the result is the same.
CELLS_PER_ROW, MAX_CELLS, HASHES = 16, 1 << 26, 4
_SLICES = 64


def digest(data: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """SHA-256 of each text without white space, and the code points of the whole text."""
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = first[at[1:]] - first[at[:-1]]
    kept = ~arrays.SPACES[data]
    bounds = np.concatenate([[0], np.cumsum(kept)])[at].tolist()
    held = memoryview(data[kept].tobytes())
    return [hashlib.sha256(held[a:b]).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], points


def with_digests(docs: DataFrame, text_column: str, sha: str, points: str, flag: str | None = None, repeats=None) -> DataFrame:
    """All columns and rows, with the digest and the number of code points; with ``repeats``, also whether others may have the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in arrays.slices(batches, text_column):
            found, n = digest(data, at)
            found = pa.array(found, pa.binary())
            rows = rows.append_column(sha, found).append_column(points, pa.array(n, pa.int64()))
            yield rows if repeats is None else rows.append_column(flag, pa.array(may_repeat(found, repeats.value)))

    more = [T.StructField(sha, T.BinaryType()), T.StructField(points, T.LongType())]
    if repeats is not None:
        more.append(T.StructField(flag, T.BooleanType()))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def cells_of(digests: pa.Array, n_cells: int) -> np.ndarray:
    """The ``HASHES`` cells of each digest: one row of the array each."""
    parts = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(len(digests), 4)
    step = np.arange(HASHES, dtype=np.uint64)
    return ((parts[:, :1] + step * (parts[:, 1:2] | np.uint64(1))) & np.uint64(n_cells - 1)).astype(np.int64)


def repeated_cells(digests: DataFrame, sha: str, n_cells: int) -> np.ndarray:
    """The bits of all cells that are marked at least twice; at most ``MAX_CELLS / 8`` bytes reach the driver."""
    width = n_cells // _SLICES

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the cells of one digest count once each, those of different rows add up
            found = np.sort(cells_of(batch.column(sha), n_cells), axis=1)
            found = found[np.concatenate([np.ones((len(found), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)]
            cells, times = np.unique(found, return_counts=True)
            at = np.searchsorted(cells, np.arange(_SLICES + 1) * width)
            for k in np.flatnonzero(np.diff(at)).tolist():
                own = slice(at[k], at[k + 1])
                yield pa.RecordBatch.from_arrays([
                    pa.array([k], pa.int32()), pa.array([(cells[own] - k * width).astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([(times[own] > 1).tobytes()], pa.binary())], ["slice", "cells", "again"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, cells, again in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                once, twice = seen.setdefault(k, (np.zeros(width, bool), np.zeros(width, bool)))
                at, more = np.frombuffer(cells, np.uint32), np.frombuffer(again, bool)
                twice[at] |= more | once[at]
                once[at] = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array([np.packbits(t, bitorder="little").tobytes() for _, t in seen.values()], pa.binary())], ["slice", "bits"])

    folded = (digests.select(sha).mapInArrow(marks, "slice int, cells binary, again binary")
              .repartition("slice").mapInArrow(fold, "slice int, bits binary"))
    bits = np.zeros(n_cells // 8, np.uint8)
    for row in folded.collect():
        bits[row.slice * width // 8 : (row.slice + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def may_repeat(digests: pa.Array, bits: np.ndarray) -> np.ndarray:
    cells = cells_of(digests, 8 * len(bits))
    return ((bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=1)


def repeats_of(digests: DataFrame, sha: str, max_cells: int = MAX_CELLS):
    """The filter of the digests that occur twice or more, as a broadcast."""
    n_cells = 1 << 12
    while n_cells < min(max_cells, CELLS_PER_ROW * digests.count()):
        n_cells *= 2
    return digests.sparkSession.sparkContext.broadcast(repeated_cells(digests, sha, n_cells))


def flag_repeated(rows: DataFrame, sha: str, flag: str, repeats) -> DataFrame:
    """``rows`` with a column that is false only where no other row has the same digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(flag, pa.array(may_repeat(batch.column(sha), repeats.value)))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(flag, T.BooleanType())]))


def exact_groups(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the text without white space.

    Of equal texts the one with the most code points stays, then the smallest id. NULL counts as the empty text. Rows
    that repeat an id and a text count one by one; one of them is kept. A NULL id sorts first. Other columns are not
    read. An empty table gives no rows.
    """
    base = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    digests = written(with_digests(base, "body", "sha", "points").drop("body"), "digests")
    flagged = flag_repeated(digests, "sha", "maybe", repeats_of(digests, "sha", max_cells))
    alone = flagged.where(~F.col("maybe")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    rows = flagged.where("maybe").groupBy("sha", "id").agg(F.max("points").alias("points"), F.count("*").alias("copies"))
    groups = rows.groupBy("sha").agg(
        F.min(F.struct(-F.col("points"), F.col("id"))).getField("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    shared = (splittable_join(rows, groups, ["sha"], "inner")
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
              .select("id", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "sha"))
    return alone.unionByName(shared).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """The rows that stay, with all their columns; ties and NULLs as in ``exact_groups``."""
    sha, points, flag = unused(docs, "text_digest"), unused(docs, "code_points"), unused(docs, "may_repeat")
    digests = written(with_digests(docs.select(id_column, text_column), text_column, sha, points).drop(text_column), "digests")
    repeats = repeats_of(digests, sha, max_cells)
    flagged = with_digests(docs, text_column, sha, points, flag, repeats)
    best = (flag_repeated(digests, sha, flag, repeats).where(flag).groupBy(sha)
            .agg(F.min(F.struct((-F.col(points)).alias("p"), F.col(id_column).alias("i"))).alias("best"))
            .select(F.col(sha).alias("s"), (-F.col("best.p")).alias("p"), F.col("best.i").alias("i")))
    stay = flagged.where(flag).join(
        best, (F.col(sha) == F.col("s")) & (F.col(points) == F.col("p")) & F.col(id_column).eqNullSafe(F.col("i")), "left_semi").dropDuplicates([sha])
    return flagged.where(~F.col(flag)).unionByName(stay).select(docs.columns)
