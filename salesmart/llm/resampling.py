"""Importance resampling towards a target corpus.

Features are runs of one to three words, hashed to buckets. The buckets' log ratios of target and raw counts, rounded to whole
gains, form one array that is broadcast; a document's weight is the sum of the gains of its features. With
Gumbel noise from a hash of the id added, the highest scores are a sample without replacement.

The k-th highest score is found by quickselect over the written scores: each round takes random pivot keys among
the rows still in question, counts exactly how many lie before, on and between them, and goes on between the two that
enclose the k-th. A key is the score, the id and, for rows alike in both, a hash of the text and the row's place in the written
table, so no two rows tie. Only the winners are sorted and ranked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import arrays, checksums
from salesmart.llm.decontamination import OUTSIDE
from salesmart.llm.storage import unused, written

BUCKETS, WORDS = 10_000, 3
SEED, LEAST_WORDS, PERCENT = 42, 20, 5
#: Pivot keys of a round; the rows in question shrink by about this factor each time.
PIVOTS = 15


@dataclass
class Features:
    """Buckets of all features of some texts, the row each belongs to, and the words of each row."""

    buckets: np.ndarray
    rows: np.ndarray
    words: np.ndarray


def features(data: np.ndarray, at: np.ndarray, buckets: int = BUCKETS, longest: int = WORDS) -> Features:
    """All runs of 1 to ``longest`` words of each text, joined by one space, as CRC-32 modulo ``buckets``."""
    low = arrays.LOWER[data]
    starts, ends, rows = arrays.words(low, at, OUTSIDE)
    own = checksums.span_sums(low, starts, ends)
    length = ends - starts
    after_space = checksums.joined(np.full(len(own), _SPACE_SUM, np.uint32), own, length)
    sums, of, run = [own], [rows], own
    for k in range(1, longest):
        run = checksums.joined(run[:-1], after_space[k:], length[k:] + 1)
        same = rows[: len(run)] == rows[k:]
        sums.append(run[same])
        of.append(rows[: len(run)][same])
    return Features((np.concatenate(sums) % np.uint32(buckets)).astype(np.int64), np.concatenate(of), arrays.counts(rows, len(at) - 1))


_SPACE_SUM = int(checksums.span_sums(np.array([32], np.uint8), np.array([0]), np.array([1]))[0])


def bucket_counts(texts: DataFrame, text_column: str = "text", buckets: int = BUCKETS, longest: int = WORDS) -> np.ndarray:
    """Features in each bucket over all rows. A task hands on one number for each bucket it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for _, data, at in arrays.slices(batches, text_column):
            seen += np.bincount(features(data, at, buckets, longest).buckets, minlength=buckets)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], ["bucket", "n"])

    found = texts.select(text_column).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t, more = raw.astype(np.float64), target.astype(np.float64), len(raw)
    ratio = (t + 1) * (s.sum() + more) / ((s + 1) * (t.sum() + more))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, *, text_column: str, names: tuple[str, str, str], longest: int = WORDS) -> DataFrame:
    """All columns but the text, with words, features and summed gains of each row, called ``names``."""
    held = docs.sparkSession.sparkContext.broadcast(gains)
    keep = [c for c in docs.columns if c != text_column]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in arrays.slices(batches, text_column):
            found = features(data, at, len(held.value), longest)
            n = batch.num_rows
            order = np.argsort(found.rows, kind="stable")
            total = np.concatenate([[0], np.cumsum(held.value[found.buckets[order]])])
            per_row = np.bincount(found.rows, minlength=n).astype(np.int64)
            ends = np.cumsum(per_row)
            out = [found.words, per_row, total[ends] - total[ends - per_row]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x, pa.int64()) for x in out)], [*keep, *names])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{n}` long" for n in names)]))


def gumbel_thousandths(id_: Column, seed: int = SEED) -> Column:
    """Gumbel noise from the first 32 bits of a SHA-256 of seed and id, in thousandths, rounded down; a NULL id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _literal(key, kind: str) -> Column:
    down, unnamed, id_, tie, row = key
    return F.struct(F.lit(down).cast("long").alias("down"), F.lit(unnamed).alias("unnamed"), F.lit(id_).cast(kind).alias("id"), F.lit(tie).cast("long").alias("tie"), F.lit(row).cast("long").alias("row"))


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED):
    """The ``k``-th smallest value (from 1) of the struct column ``key``, whose values all differ; ``k`` rows at least are there.

    ``down``, the first field, is also a column of its own, so that a scan skips files and row groups out of bounds.
    """
    kind = dict(keys.select("key.*").dtypes)["id"]
    low = high = None
    for turn in range(1, 10_000):
        pool = keys
        if low is not None:
            pool = pool.where((F.col("down") >= low[0]) & (F.col("key") > _literal(low, kind)))
        if high is not None:
            pool = pool.where((F.col("down") <= high[0]) & (F.col("key") < _literal(high, kind)))
        drawn = pool.select("key").orderBy(F.xxhash64("key.row", F.lit(seed + turn)), "key.row").limit(pivots).collect()
        marks = sorted(tuple(r.key) for r in drawn)
        before = sum((F.when(F.col("key") > _literal(m, kind), 2).when(F.col("key") == _literal(m, kind), 1).otherwise(0) for m in marks), F.lit(0))
        counts = {r.place: r.n for r in pool.groupBy(before.alias("place")).agg(F.count("*").alias("n")).collect()}
        for place in range(2 * len(marks) + 1):
            here = counts.get(place, 0)
            if k <= here:
                break
            k -= here
        if place % 2:
            return marks[place // 2]
        low = marks[place // 2 - 1] if place else low
        high = marks[place // 2] if place < 2 * len(marks) else high
    raise RuntimeError("quickselect did not end")


def with_ranks(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``rows`` sorted over all tasks and numbered from 1: by place in the task, and rows in the tasks before."""
    place = unused(rows, "place")
    placed = written(rows.orderBy(*order).withColumn(place, F.monotonically_increasing_id()), "ranked")
    task = F.shiftright(F.col(place), 33)
    many = sorted((r[0], r[1]) for r in placed.groupBy(task.alias("t")).agg(F.count("*").alias("n")).collect())
    before, start = 0, []
    for t, n in many:
        start.append((t, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(start, "`_task` long, `_before` long")  # a row per task of the sort
    joined = placed.join(F.broadcast(offsets), task == F.col("_task"))
    return joined.withColumn(rank, F.col("_before") + F.col(place).bitwiseAND((1 << 33) - 1) + 1).drop("_task", "_before", place)


def resample(docs: DataFrame, target: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = WORDS) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_features``, ``weight``, ``score``, and ``rank`` of those drawn (else NULL).

    Drawn are the ``percent`` (rounded down) of the documents with ``least_words`` or more that score highest; ties go to
    the smaller id, then NULL ids, and rows that share score and id are drawn one by one. NULL and empty texts have no features
    and weight 0. Other columns are not read. Empty tables give no rows, an empty target is a target without features.
    """
    gains = bucket_gains(bucket_counts(docs, text_column, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    base = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("tie"), F.col(text_column).alias("body"))
    weighed = weights(base, gains, text_column="body", names=("n_words", "n_features", "weight"), longest=longest)
    scored = written(weighed.withColumn("score", F.col("weight") + gumbel_thousandths(F.col("id"), seed)).withColumn("row", F.monotonically_increasing_id()), "scores")
    key = F.struct((-F.col("score")).alias("down"), F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("tie"), F.col("row"))
    able = F.col("n_words") >= least_words
    wanted = scored.where(able).count() * percent // 100
    out = [F.col("id").alias(id_column), "n_words", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    keyed = scored.where(able).select((-F.col("score")).alias("down"), key.alias("key"))
    last = _literal(kth_key(keyed, wanted, seed=seed), dict(scored.dtypes)["id"])
    wins = able & (key <= last)
    winners = with_ranks(scored.where(wins), [F.desc("score"), F.col("id").asc_nulls_last(), F.col("tie"), F.col("row")], "rank")
    return winners.select(*out, "rank").unionByName(scored.where(~wins).select(*out, F.lit(None).cast("long").alias("rank")))
