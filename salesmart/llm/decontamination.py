"""Occurrences of benchmark passages in documents by Wu-Manber search over words.

Patterns are windows of benchmark words. A table over hashed blocks of ``BLOCK`` words says how far a search may move
on when it sees a block: over all positions where no pattern can end. Blocks that end a pattern have shift 0 and lead to a bucket
of patterns with that suffix, whose words are then compared, by hash first and then as bytes. Many positions of a slice
of documents advance in step, so each step is a few array operations.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import arrays
from salesmart.llm.storage import unused, written

WINDOW = 10
BLOCK = 2
#: Bytes of benchmark text whose tables are broadcast at once; a larger benchmark is searched for in several rounds.
ROUND_BYTES = 32_000_000
#: Ends of windows that one search walks over.
_STRIDE = 256
_TABLE_BITS = 18
_A = np.uint64(0x9E3779B97F4A7C15)

OUTSIDE = np.ones(256, bool)
OUTSIDE[48:58] = OUTSIDE[97:123] = OUTSIDE[128:] = False


def word_hashes(data: np.ndarray, at: np.ndarray):
    """Bytes in lower case, starts, ends and rows of the words, and their hashes."""
    low = arrays.LOWER[data]
    starts, ends, rows = arrays.words(low, at, OUTSIDE)
    return low, starts, ends, rows, arrays.span_hashes(arrays.running(low), starts, ends)


class Patterns:
    """Shift table and suffix buckets of patterns of ``least`` words or more."""

    def __init__(self, found: dict[tuple[bytes, ...], list]):
        self.words = list(found)
        self.items = list(found.values())
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.least = int(self.lengths.min())
        self.block = min(BLOCK, self.least)
        longest = int(self.lengths.max())
        joined = b" ".join(b" ".join(w) for w in self.words)
        data = np.frombuffer(joined, np.uint8)
        *_, flat = word_hashes(data, np.array([0, len(data)]))
        first = np.cumsum(self.lengths) - self.lengths
        grid = first[:, None] + np.minimum(np.arange(longest), self.lengths[:, None] - 1)
        self.hashes = flat[grid]  # rows are filled up with their last word
        self.shift = np.full(1 << _TABLE_BITS, self.least - self.block + 1, np.int64)
        for q in range(self.least - self.block + 1):
            blocks = self.blocks(self.hashes[:, q : q + self.block])
            np.minimum.at(self.shift, blocks, self.least - self.block - q)
        suffix = self.blocks(self.hashes[:, self.least - self.block : self.least])
        self.order = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[self.order], np.arange((1 << _TABLE_BITS) + 1))

    @staticmethod
    def blocks(hashes: np.ndarray) -> np.ndarray:
        h = hashes[:, 0]
        for j in range(1, hashes.shape[1]):
            h = h * _A + hashes[:, j]
        return (arrays.mix(h) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts (as word numbers) and patterns of all occurrences by hash; ``bounds``: where each row's words start."""
        stop = np.repeat(bounds[1:], np.maximum(0, -(-(bounds[1:] - bounds[:-1] - self.least + 1) // _STRIDE)))
        parts = np.maximum(0, -(-(bounds[1:] - bounds[:-1] - self.least + 1) // _STRIDE))
        number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(bounds[:-1], parts) + self.least - 1 + number * _STRIDE
        end = np.minimum(stop, at + _STRIDE)
        stopped = []
        back = np.arange(self.block - 1, -1, -1)
        while len(at):
            shift = self.shift[self.blocks(hashes[at[:, None] - back])]
            stopped.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            at, end = at[at < end], end[at < end]
        last = np.concatenate(stopped) if stopped else np.zeros(0, np.int64)
        if not len(last):
            return last, last
        block = self.blocks(hashes[last[:, None] - back])
        many = self.bucket[block + 1] - self.bucket[block]
        which = self.order[np.repeat(self.bucket[block], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        start = np.repeat(last, many) - self.least + 1
        row_end = bounds[np.searchsorted(bounds, start, "right")]
        keep = start + self.lengths[which] <= row_end
        start, which = start[keep], which[keep]
        for j in range(self.hashes.shape[1]):
            inside = np.minimum(j, self.lengths[which] - 1)
            keep = hashes[start + inside] == self.hashes[which, j]
            start, which = start[keep], which[keep]
        return start, which


def compile_items(items: list[tuple], window: int = WINDOW) -> list[Patterns]:
    """Windows of whole length, and the items that are shorter, each with the ids they belong to."""
    whole, short = defaultdict(list), defaultdict(list)
    for item, text in items:
        low, starts, ends, _, _ = word_hashes(*arrays.texts(pa.array([text], pa.string())))
        held = low.tobytes()
        words = [held[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        if 0 < len(words) < window:
            short[tuple(words)].append(item)
        for i in range(len(words) - window + 1):
            if item not in whole[key := tuple(words[i : i + window])]:
                whole[key].append(item)
    return [Patterns(found) for found in (whole, short) if found]


def occurrences(patterns: list[Patterns], data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[list[tuple]]]:
    """Words of each row, and its occurrences as (first word, word after the last, items)."""
    low, starts, ends, rows, hashes = word_hashes(data, at)
    n = arrays.counts(rows, len(at) - 1)
    bounds = np.concatenate([[0], np.cumsum(n)])
    found: list[list[tuple]] = [[] for _ in n]
    held = low.tobytes()
    for p in patterns:
        first, which = p.search(hashes, bounds)
        for a, k in zip(first.tolist(), which.tolist(), strict=True):
            words = p.words[k]
            if all(held[starts[a + j] : ends[a + j]] == w for j, w in enumerate(words)):
                row = int(rows[a])
                found[row].append((a - int(bounds[row]), a - int(bounds[row]) + len(words), p.items[k]))
    return n, found


def covered(spans: list[tuple]) -> int:
    total, end = 0, 0
    for a, b in sorted(s[:2] for s in spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


NAMES = ("n_words", "n_hit", "n_items", "items")
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPANS_SQL = "array<struct<first:long,last:long>>"


def contamination(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, round_bytes: int = ROUND_BYTES, keep: list[str] | None = None,
                  names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """Columns ``keep`` (the id) of each row, its words, words hit, items, and item ids as sorted strings, called ``names``.

    An item of fewer than ``window`` words is one pattern; NULL and word-free texts, of items too, match nothing. Items
    with equal windows are all listed; ids that repeat count once, NULL ids not at all. Rows that repeat are judged one
    by one. Of the benchmark, ``round_bytes`` at most are on the driver and in a broadcast at once; beyond that the
    documents are searched in several rounds, each of which writes its hits for the next one.
    """
    keep = keep or [id_column]
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    rounds = max(1, -(-size // round_bytes))
    known = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    rows = docs.select(*dict.fromkeys([*keep, text_column]))
    spans, listed = unused(rows, "hit_spans"), unused(rows, "hit_items")
    for k in range(rounds):
        own = known if rounds == 1 else known.where(F.pmod(F.xxhash64("i"), F.lit(rounds)) == k)
        patterns = docs.sparkSession.sparkContext.broadcast(compile_items(sorted({(r.i, r.t) for r in own.collect()}, key=repr), window))
        rows = _search(rows, patterns, text_column, spans, listed, keep if k == rounds - 1 else None, names)
        if k < rounds - 1:
            rows = written(rows, "hits")
    return rows


def _search(rows: DataFrame, patterns, text_column: str, spans: str, listed: str, keep: list[str] | None, names: tuple) -> DataFrame:
    """All columns with what was found so far, or, with ``keep``, the results."""
    more = spans in rows.columns
    columns = keep or [c for c in rows.columns if c not in (spans, listed)]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in arrays.slices(batches, text_column):
            n, found = occurrences(patterns.value, data, at)
            ids = [{i for s in row for i in s[2]} for row in found]
            places = [{s[:2] for s in row} for row in found]
            if more:
                ids = [a.union(b) for a, b in zip(ids, batch.column(listed).to_pylist(), strict=True)]
                places = [a | {(s["first"], s["last"]) for s in b} for a, b in zip(places, batch.column(spans).to_pylist(), strict=True)]
            ids = pa.array([sorted(x) for x in ids], pa.list_(pa.string()))
            if keep:
                out = [pa.array(n, pa.int64()), pa.array([covered(list(x)) for x in places], pa.int64()), pa.array([len(x) for x in ids], pa.int64()), ids]
            else:
                out = [pa.array([[{"first": a, "last": b} for a, b in sorted(x)] for x in places], _SPANS), ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *out], [*columns, *(names if keep else (spans, listed))])

    added = ", ".join(f"`{c}` {t}" for c, t in (zip(names, ("long", "long", "long", "array<string>"), strict=True) if keep else ((spans, _SPANS_SQL), (listed, "array<string>"))))
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", " + added)
