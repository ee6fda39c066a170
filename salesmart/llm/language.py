"""Language identification by error-correcting output codes over byte n-grams.

Each language has a codeword of +1 and -1; for each of its bits a linear classifier weighs hashed n-grams by the log
ratio of their smoothed rates in the languages with +1 and those with -1, every language weighing the same. A text is
decoded to the codeword with the smallest sum of logistic losses over the bits, each weighted by how far its two sides
differ; a text whose two best codewords are close is flagged.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import arrays

#: Hashed n-grams of so many bytes; the table of counts has FEATURES entries a language.
ORDERS, FEATURES = (2, 3, 4), 1 << 14
SMOOTHING = 0.5
#: A text's margins are means over its n-grams times this many at most (and its number of n-grams if that is less).
EVIDENCE = 60
#: Codewords closer than this in loss per evidence make a text ambiguous.
CLOSE = 0.02
#: Above so many languages that codewords are drawn instead of listed whole; bits drawn per doubling of the languages.
EXHAUSTIVE, BITS_PER_DOUBLING = 5, 10
UNKNOWN = "und"

_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language: all splits in two for a few languages, else the best of 64 random draws."""
    if n <= EXHAUSTIVE:
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=n - 1) if -1 in s]
        return np.array(splits, np.int8).T.reshape(n, -1) if splits else np.ones((n, 1), np.int8)
    bits, best = int(np.ceil(BITS_PER_DOUBLING * np.log2(n))), (-1, None)
    for seed in range(64):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        near = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(near, -bits)
        best = max(best, (int(bits - near.max()), seed))
    code = np.random.default_rng(best[1]).choice(np.array([-1, 1], np.int8), (n, bits))
    return code[:, np.abs(code.sum(axis=0)) < n]


def grams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: the feature of each n-gram that lies within a row and has a letter, and its row."""
    low = _PLAIN[arrays.lower_latin(data)].astype(np.uint32)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for n in ORDERS:
        if len(low) < n:
            continue
        m = len(low) - n + 1
        value = np.zeros(m, np.uint32)
        blank = np.ones(m, bool)
        for j in range(n):
            value = value << np.uint32(8) | low[j : j + m]
            blank &= low[j : j + m] == 32
        keep = (row[:m] == row[n - 1 :]) & ~blank
        value = (value[keep] ^ np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)
        yield (value >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int64), row[:m][keep]


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)).astype(np.float64)
        rates = counts + SMOOTHING
        rates = rates / rates.sum(axis=1, keepdims=True)
        self.weights = np.zeros((FEATURES, self.code.shape[1]), np.float32)
        self.trust = np.ones(self.code.shape[1])
        for b, side in enumerate(self.code.T):
            if not (side < 0).any():
                continue
            p, q = rates[side > 0].mean(axis=0), rates[side < 0].mean(axis=0)
            middle = (p + q) / 2
            self.weights[:, b] = np.log(p / q)
            self.trust[b] = ((p * np.log(p / middle)).sum() + (q * np.log(q / middle)).sum()) / 2
        self.trust /= self.trust.mean() or 1

    def decode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the language's number, its share of the likelihood, whether it is ambiguous, its n-grams."""
        n = len(at) - 1
        margin, seen = np.zeros((n, self.code.shape[1])), np.zeros(n)
        for feature, row in grams(data, at):
            own = np.bincount(row, minlength=n)
            seen += own
            filled = np.flatnonzero(own)
            if len(filled):
                margin[filled] += np.add.reduceat(self.weights[feature], (np.cumsum(own) - own)[filled], axis=0)
        evidence = np.minimum(seen, EVIDENCE)
        margin *= (evidence / np.maximum(seen, 1))[:, None]
        loss = (np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.trust).sum(axis=2)
        order = np.sort(loss, axis=1)
        share = 1 / np.exp(order[:, :1] - order).sum(axis=1)
        close = (order[:, 1] - order[:, 0]) < CLOSE * np.maximum(evidence, 1) if loss.shape[1] > 1 else np.zeros(n, bool)
        return loss.argmin(axis=1), share, close, seen


def train(docs: DataFrame, *, text_column: str = "text", language_column: str = "lang") -> Model | None:
    """Counts over all rows that have a text and a language; None if there are none.

    What reaches the driver is one table of at most FEATURES counts per language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows, data, at in arrays.slices(batches, text_column):
            names, group = np.unique(np.array(rows.column(language_column).to_pylist(), object).astype(str), return_inverse=True)
            for feature, row in grams(data, at):
                own = np.bincount(group[row] * FEATURES + feature, minlength=len(names) * FEATURES).reshape(len(names), FEATURES)
                for name, c in zip(names.tolist(), own, strict=True):
                    sums[name] = sums.get(name, 0) + c
        for name, c in sums.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(c[some], pa.int64())], ["language", "feature", "n"])

    labelled = docs.where(F.col(text_column).isNotNull() & F.col(language_column).isNotNull()).select(text_column, language_column)
    counted = labelled.mapInArrow(count, "language string, feature int, n long").groupBy("language", "feature").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counted["language"].to_pylist()))
    if not languages:
        return None
    table = np.zeros((len(languages), FEATURES))
    table[np.searchsorted(languages, counted["language"].to_pylist()), counted["feature"].to_numpy()] = counted["n"].to_numpy()
    return Model(languages, table)


def identify(docs: DataFrame, model: Model | None, *, text_column: str = "text", keep: list[str],
             names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """Columns ``keep`` of each row with its language, its score (0 to 1) and whether it is ambiguous, called ``names``.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing was learnt. A text whose letters the
    n-grams do not know goes to the nearest codeword like any other, flagged ambiguous. Rows that repeat get equal answers.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        languages = model.languages if model else [UNKNOWN]
        for rows, data, at in arrays.slices(batches, text_column):
            text = memoryview(data.tobytes())
            lettered = np.array([any(map(str.isalpha, str(text[a:b], "utf-8", "replace"))) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], bool)
            if model is None:
                best, share, close = np.zeros(len(lettered), int), np.zeros(len(lettered)), lettered
            else:
                best, share, close, _ = model.decode(data, at)
            said = [languages[k] if has else UNKNOWN for k, has in zip(best.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(said, pa.string()), pa.array(np.where(lettered, share, 0.0)), pa.array(close & lettered)],
                                             [*keep, *names])

    head = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, text_column])).mapInArrow(run, f"{head}, `{names[0]}` string, `{names[1]}` double, `{names[2]}` boolean")
