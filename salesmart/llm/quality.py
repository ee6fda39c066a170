"""Document quality by the votes of the nearest labelled documents in a latent space.

Features are hashed trigrams of the text's outline (letters as ``a`` or ``A``, digits as ``0``, marks as they are), hashed
trigrams of its bytes, and whether words repeat the word before. Weighted by inverse document frequency over all
documents, the labelled rows give a basis of latent dimensions by singular value decomposition, in one task as their
number is bounded; the driver gets the basis, their latent vectors and labels, and broadcasts them. Each document's
cosine with every labelled vector comes from one matrix product per block of documents, and its nearest ones vote with
weights that grow with similarity.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import arrays

#: Hashed features: half for outlines and repeats, half for bytes.
FEATURES = 4096
#: Latent dimensions, votes counted, and steepness of the weights.
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 25, 12.0
#: Bound of the labelled rows that are learnt from: so many of each label, those with the smallest hash of their id.
ROWS_PER_LABEL = 1000
#: What a word that repeats the word before counts for.
REPEAT_WEIGHT = 16
_BLOCK_ROWS = 256
_HALF = FEATURES // 2
_SHIFT = np.uint32(32 - _HALF.bit_length() + 1)

_OUTLINE = np.arange(256, dtype=np.uint8)
_OUTLINE[97:123] = _OUTLINE[128:] = 97
_OUTLINE[65:91] = 65
_OUTLINE[48:58] = 48
_OUTLINE[9:14] = 32


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Square roots of the feature counts: a row per text."""
    n = len(at) - 1
    out = np.zeros((n, FEATURES), np.float32)
    if not len(data):
        return out
    row = np.repeat(np.arange(n), np.diff(at))
    if len(data) > 2:
        inside = row[:-2] == row[2:]
        for k, code in enumerate((_OUTLINE[data], data)):
            code = code.astype(np.uint32)
            value = (code[:-2] << np.uint32(16) | code[1:-1] << np.uint32(8) | code[2:])[inside]
            place = ((value * np.uint32(0x9E3779B1)) >> _SHIFT).astype(np.int64)
            place[place == 0] = 1  # entries 0 and _HALF are kept for the words
            out[:, k * _HALF : (k + 1) * _HALF] = np.bincount(row[:-2][inside] * _HALF + place, minlength=n * _HALF).reshape(n, _HALF)
    starts, ends, of = arrays.words(data, at, arrays.SPACES)
    if len(starts) > 1:
        hashes = arrays.span_hashes(arrays.running(data), starts, ends)
        same, mate = hashes[1:] == hashes[:-1], of[1:] == of[:-1]
        out[:, 0] = REPEAT_WEIGHT * np.bincount(of[1:][same & mate], minlength=n)
        out[:, _HALF] = np.bincount(of[1:][mate & ~same], minlength=n)
    return np.sqrt(out)


class Model:
    def __init__(self, idf: np.ndarray, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        """``weights``: what a row of each label stands for among all labelled rows."""
        self.idf = idf.astype(np.float32)
        self.labels, self.weights = labels.astype(np.float32), weights.astype(np.float32)[labels]
        self.default = float((self.labels * self.weights).sum() / self.weights.sum()) if len(rows) else 0.5
        scaled = self._unit(rows * self.idf)
        self.basis = np.zeros((FEATURES, 0), np.float32)
        if len(rows):
            _, _, axes = np.linalg.svd(scaled, full_matrices=False)
            self.basis = axes[:DIMENSIONS].T.astype(np.float32)
        self.known = self._unit(scaled @ self.basis)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def score(self, found: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest; the share of all where a text has no features."""
        if not len(self.known):
            return np.full(len(found), self.default)
        vectors = self._unit(self._unit(found * self.idf) @ self.basis)
        near = vectors @ self.known.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        similar = np.take_along_axis(near, best, axis=1)
        vote = np.exp(SHARPNESS * (similar - 1)) * self.weights[best]
        said = (vote * self.labels[best]).sum(axis=1) / vote.sum(axis=1)
        return np.where(found.any(axis=1), said, self.default).astype(np.float64)


def _sample(labels: DataFrame, id_column: str, label_column: str, size: int) -> DataFrame:
    """At most ``size`` ids of each label, smallest hash first."""
    own = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).select(id_column, F.col(label_column).cast("int").alias("label")).distinct()
    parts = [own.where(F.col("label") == k).orderBy(F.xxhash64(id_column), id_column).limit(size) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", size: int = ROWS_PER_LABEL) -> Model:
    """Document frequencies over all ``docs``, vectors of at most ``2 * size`` labelled rows.

    The sample is bounded by ``size``; its rows are weighted so that both labels count as they do among all labelled
    rows. Labels other than 0 and 1 are not learnt from; an id with both labels counts as both. Of different texts under one id the one
    with the smallest hash is learnt from.
    """
    spark = docs.sparkSession

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(FEATURES, np.int64)
        for rows, data, at in arrays.slices(batches, text_column, most=_BLOCK_ROWS):
            seen += (features(data, at) > 0).sum(axis=0)
            n += rows.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1), pa.int32()), pa.array(np.append(seen, n))], ["feature", "n"])

    df = docs.select(text_column).mapInArrow(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(FEATURES + 1)
    count[df["feature"].to_numpy()] = df["n"].to_numpy()
    idf = np.log((1 + count[-1]) / (1 + count[:-1])) + 1
    sample = {}
    for r in _sample(labels, id_column, label_column, size).collect():
        sample.setdefault(r[0], []).append(r[1])
    wanted = spark.createDataFrame([*sample.items()], f"id {dict(labels.dtypes)[id_column]}, labels array<int>")
    all_labels = {r[0]: r[1] for r in labels.where(F.col(label_column).isin(0, 1)).groupBy(F.col(label_column).cast("int")).count().collect()}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in arrays.slices(batches, most=_BLOCK_ROWS):
            found = pa.array([x.tobytes() for x in features(data, at)], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("labels"), found], ["id", "labels", "x"])

    def fitted(x: np.ndarray, y: np.ndarray) -> Model:
        return Model(idf, x, y, np.array([all_labels.get(k, 0) / max(1, (y == k).sum()) for k in (0, 1)]))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(x.as_buffer(), np.float32), own) for batch in batches for x, own in zip(batch.column("x"), batch.column("labels").to_pylist(), strict=True)]
        if rows:
            model = fitted(np.array([x for x, own in rows for _ in own]), np.array([k for _, own in rows for k in own], int))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = (texts.join(F.broadcast(wanted), "id").groupBy("id").agg(F.first("labels").alias("labels"), F.min_by("text", F.xxhash64("text")).alias("text"))
            .mapInArrow(vectors, f"id {dict(docs.dtypes)[id_column]}, labels array<int>, x binary"))
    # one task, as these are at most 2 * size ids; the vectors and their decomposition are too much for a small driver
    models = rows.repartition(1).sortWithinPartitions("id").mapInArrow(fit, "model binary").collect()
    return pickle.loads(models[0].model) if models else fitted(np.zeros((0, FEATURES), np.float32), np.zeros(0, int))


def score(docs: DataFrame, model: Model, *, text_column: str = "text", keep: list[str]) -> DataFrame:
    """Columns ``keep`` of each row with ``score`` between 0 and 1; NULL and empty texts get the share of label 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in arrays.slices(batches, text_column, most=_BLOCK_ROWS):
            said = np.clip(held.value.score(features(data, at)), 0, 1)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(said)], [*keep, "score"])

    return docs.select(*dict.fromkeys([*keep, text_column])).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double")
