"""Removal of repeated passages with a logarithmic family of suffix arrays.

A suffix array here covers the suffixes of its documents that start at a winnowed place: of every ``WINNOW`` starts in
a row the one whose next ``GRAM`` bytes hash lowest (the first of equals). Any string of ``LENGTH`` bytes holds such a
place, the same one wherever the string stands, so two occurrences of a long string meet at suffixes that share their
first ``GRAM`` bytes. An array is sorted by the hash of these bytes, its beginnings, with the number of suffixes of each, and kept in as
many buckets; the suffixes themselves are read from the documents when they are needed.

Documents come in batches. A new batch gets an array of its own, which is merge-scanned against every array of the
family, bucket by bucket, for equal beginnings; then it joins the family. Before that, arrays of equal rank are merged,
so a family of n batches has at most log2(n) + 1 arrays and every entry is merged log2(n) times.

Suffixes whose beginnings met are looked at with their surroundings, all the strings that chose their place. Equal surroundings are
all repeats but for the first. The first ones of different surroundings are compared, each with the earlier ones, by the 64-bit hashes of the strings
they hold under their common beginning: in the task that has the beginning or, where its surroundings are too many for a
task, string by string over all tasks. Two filters of bounded size tell the tasks that read the documents which suffixes to report; what a
filter lets through for nothing is settled by the comparison.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import arrays, bloom
from salesmart.llm.storage import written
from salesmart.operators.joins import splittable_join

LENGTH, GRAM = 100, 32
WINNOW = LENGTH - GRAM + 1
#: Batches that the query cuts the table into.
BATCHES = 4
#: Beginnings with more different surroundings than this (up to LENGTH - GRAM + 1 strings each, at some 60 bytes in a task) are compared string by string over all tasks.
MANY = 50_000
BROADCAST_ROWS = 1_000_000
#: The place of a NULL id in the order of documents: before all others.
_NULL = -(1 << 63)


def winnowed(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row with ``LENGTH`` bytes or more: row, place, hash of the next GRAM bytes, first and last string start that chose the place.

    Places and starts are counted in ``data``.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64), none, none
    starts = np.arange(len(data) - GRAM + 1)
    hashes = arrays.span_hashes(arrays.running(data), starts, starts + GRAM)
    # lowest hash of WINNOW in a row, by doubling; equal hashes keep the first place
    best, width = starts, 1
    while width < WINNOW:
        step = min(width, WINNOW - width)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(hashes[right] < hashes[left], right, left)
        width += step
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = np.flatnonzero(row[: len(best)] == row[LENGTH - 1 : LENGTH - 1 + len(best)])
    chosen = best[whole]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (whole[1:] != whole[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(chosen))[: len(first)] - 1
    place = chosen[first]
    return row[whole[first]], place, hashes[place], whole[first], whole[last]


def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``start``: hash of the beginning of each suffix."""
    for _, data, at in arrays.slices(batches, "body"):
        yield pa.RecordBatch.from_arrays([pa.array(winnowed(data, at)[2].view(np.int64))], ["start"])


@dataclass
class Family:
    """Arrays as tables, sorted and bucketed by the hash of the beginning; ``levels`` holds (rank, table) of each."""

    spark: SparkSession
    buckets: int
    levels: list[tuple[int, str]] = field(default_factory=list)

    def _store(self, rows: DataFrame) -> str:
        """``rows`` has ``start`` and ``n``, several times perhaps."""
        name = f"llm_suffixes_{uuid.uuid4().hex}"
        array = rows.repartition(self.buckets, "start").groupBy("start").agg(F.sum("n").alias("n")).sortWithinPartitions("start")
        array.write.bucketBy(self.buckets, "start").sortBy("start").saveAsTable(name)
        return name

    def merge_equal(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, self._store(self.spark.table(a).unionByName(self.spark.table(b)))))
            for name in (a, b):
                self.spark.sql(f"DROP TABLE {name}")

    def add(self, docs: DataFrame) -> list[DataFrame]:
        """Takes a batch (column ``body``) in; returns tables of the beginnings of its suffixes that met another one."""
        self.merge_equal()
        name = self._store(docs.select("body").mapInArrow(beginnings, "start long").withColumn("n", F.lit(1).cast("long")))
        new = self.spark.table(name)
        met = [new.where("n > 1").select("start")]
        met += [new.join(self.spark.table(other), "start", "left_semi").select("start") for _, other in self.levels]
        self.levels.append((0, name))
        return [written(m, "met") for m in met]

    def drop(self) -> None:
        for _, name in self.levels:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels.clear()


def _rows_with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in arrays.slices(batches, "body"):
        held = memoryview(data.tobytes())
        found = [hashlib.sha256(held[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(found, pa.binary()), pa.array(np.diff(at), pa.int64())], ["key", "sha", "n"])


_NARROW = "start long, way long, key long, version long, place int, lo long, hi long"
_AROUND = "start long, text binary, key long, version long, place int, lo long, hi long"
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def _suffix(start: np.ndarray, way: np.ndarray, key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """One number for a suffix: beginning, surroundings, document and place."""
    h = arrays.mix(start.view(np.uint64) ^ arrays.mix(way.view(np.uint64) + _SALT))
    return arrays.mix(h ^ arrays.mix(key.view(np.uint64) * _SALT + place.astype(np.uint64))).view(np.int64)


def _looked_at(met, wanted=None):
    """Suffixes of documents whose beginnings are in the filter ``met``; with ``wanted``, those that it holds, with bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in arrays.slices(batches, "body"):
            row, place, start, first, last = winnowed(data, at)
            hit = np.flatnonzero(bloom.may_hold(met.value, start))
            row, place, start, first, last = row[hit], place[hit], start[hit].view(np.int64), first[hit], last[hit]
            way = arrays.span_hashes(arrays.running(data), first, last + LENGTH)
            way = arrays.mix(way + (place - first).astype(np.uint64) * _SALT).view(np.int64)
            key, version = rows.column("key").to_numpy()[row], rows.column("version").to_numpy()[row]
            base = at[row]
            if wanted is not None:
                hit = np.flatnonzero(bloom.may_hold(wanted.value, _suffix(start, way, key, place - base)))
                row, place, start, first, last, way, key, version, base = (x[hit] for x in (row, place, start, first, last, way, key, version, base))
                held = data.tobytes()
                seen = [pa.array([held[a:b] for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)], pa.binary())]
            else:
                seen = [pa.array(way)]
            yield pa.RecordBatch.from_arrays([pa.array(start), *seen, pa.array(key), pa.array(version), pa.array((place - base).astype(np.int32)), pa.array(first - base), pa.array(last - base)],
                                             [c.split()[0] for c in (_NARROW if wanted is None else _AROUND).split(", ")])

    return run


_MARKS = "key long, version long, lo long, hi long"


def _windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset and hash of every string of ``LENGTH`` bytes in each text."""
    data, at = arrays.texts(column.cast(pa.large_binary()).view(pa.large_string()))
    n = np.diff(at) - LENGTH + 1
    own = np.repeat(np.arange(len(n)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = at[own] + offset
    return own, offset, arrays.span_hashes(arrays.running(data), first, first + LENGTH)


def _compare(table: pa.Table) -> list[tuple]:
    """Marks for whole groups of rows with equal ``start``, in order of key and place: strings that an earlier row has."""
    start, key, place, lo, version = (table.column(c).to_numpy() for c in ("start", "key", "place", "lo", "version"))
    own, offset, hashes = _windows(table.column("text").combine_chunks())
    name = arrays.mix(hashes ^ arrays.mix(start.view(np.uint64))[own])
    order = np.argsort(name, kind="stable")  # equal strings stay in order of key and place
    new = np.ones(len(order), bool)
    new[1:] = name[order[1:]] != name[order[:-1]]
    first = own[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    later[order] = (key[own[order]] != key[first]) | (place[own[order]] != place[first])
    # strings of a row that follow each other are one mark
    begins, ends = later.copy(), later.copy()
    same = own[1:] == own[:-1]
    begins[1:] &= ~(later[:-1] & same)
    ends[:-1] &= ~(later[1:] & same)
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    row = own[begins]
    return list(zip(key[row].tolist(), version[row].tolist(), (lo[row] + offset[begins]).tolist(), (lo[row] + offset[ends] + LENGTH).tolist(), strict=True))


def _marks_of(marks: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*marks, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["key", "version", "lo", "hi"])


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of a partition sorted by ``start``; one that a batch ends in waits for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        start = table.column("start").to_numpy()
        cut = int(np.searchsorted(start, start[-1])) if len(start) else 0
        held = table.slice(cut)
        if cut:
            yield _marks_of(_compare(table.slice(0, cut)))
    if held is not None and held.num_rows:
        yield _marks_of(_compare(held))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``start``, ``string``, ``key``, ``version``, ``lo``): a row for each string that chose the place, by hash."""
    for batch in batches:
        for row in range(0, batch.num_rows, 512):
            part = batch.slice(row, 512)
            own, offset, hashes = _windows(part.column("text"))
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([part.column("start").take(take), pa.array(hashes.view(np.int64)), part.column("key").take(take), part.column("version").take(take),
                                              pa.array(part.column("lo").to_numpy()[own] + offset)], ["start", "string", "key", "version", "lo"])


def _later_strings(many: DataFrame) -> DataFrame:
    """Marks among suffixes whose beginnings have many surroundings; strings are dealt by their own hash."""
    strings = written(many.select("start", "text", "key", "version", "lo").mapInArrow(_strings, "start long, string long, key long, version long, lo long"), "strings")
    at = F.struct("key", "lo")
    first = strings.groupBy("start", "string").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return splittable_join(strings, first, ["start", "string"], "inner").where(at > F.col("first")).select("key", "version", "lo", (F.col("lo") + LENGTH).alias("hi"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in arrays.slices(batches, "body"):
        removed, spans, left = [], [], []
        for r, marks in enumerate(rows.column("marks").to_pylist()):
            gone = np.zeros(int(at[r + 1] - at[r]) + 1, np.int64)
            lo, hi = np.array([m["lo"] for m in marks]), np.array([m["hi"] for m in marks])
            np.add.at(gone, lo, 1)
            np.add.at(gone, hi, -1)
            out = np.cumsum(gone[:-1]) > 0
            removed.append(int(out.sum()))
            spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
            left.append(data[at[r] : at[r + 1]][~out].tobytes())
        yield pa.RecordBatch.from_arrays([rows.column("key"), rows.column("version"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(left, pa.binary())],
                                         ["key", "version", "n_removed", "n_spans", "kept"])


def _of_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, "key", "left_semi")


def repeated_passages(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", batches: int = BATCHES, many: int = MANY, texts: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, on request, the bytes ``kept``.

    Bytes are removed that lie in a string of ``LENGTH`` bytes which starts earlier too: in a document with a smaller
    id or earlier in the same one. A NULL text is empty; a NULL id comes before all others. Rows with one id count as
    versions of one document: a string is earlier only at a smaller place. Other columns are not read. Ids are integers.
    """
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_NULL)).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("body"))
    rows = written(base.mapInArrow(_rows_with_digest, "key long, sha binary, n long"), "rows")
    # whole copies of an earlier document go without a comparison
    copies = rows.groupBy("sha").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("sha", "first")
    judged = written(splittable_join(rows, copies, ["sha"], "left").withColumn("copy", F.coalesce(F.col("key") > F.col("first"), F.lit(False))).drop("first"), "judged")
    gone = judged.where("copy").select("key").distinct()
    known = judged.where(~F.col("copy")).select("key").distinct()
    twice = written(gone.join(known, "key", "left_anti"), "copies")  # ids of which every row is a copy
    alone = base.join(F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice, "key", "left_anti")

    # documents of one id are told apart by a version; it is 0 for all others
    several = written(judged.groupBy("key").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).where("a < b").select("key", F.lit(1).alias("several")), "several")
    few_ids = several.count() <= BROADCAST_ROWS

    def versioned(rows: DataFrame, sha) -> DataFrame:
        return (rows.join(F.broadcast(several) if few_ids else several, "key", "left")
                .withColumn("version", F.when(F.col("several") == 1, F.xxhash64(sha)).otherwise(F.lit(0).cast("long"))).drop("several"))

    alone = versioned(alone, F.sha2(F.col("body").cast("binary"), 256))
    judged = versioned(judged, F.lower(F.hex("sha")))

    cuts = judged.where(F.col("n") >= LENGTH).approxQuantile("key", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    family = Family(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    met, edges = [], [None, *sorted(set(cuts)), None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        batch = alone if low is None else alone.where(F.col("key") > int(low))
        met += family.add(batch if high is None else batch.where(F.col("key") <= int(high)))
    starts = met[0]
    for m in met[1:]:
        starts = starts.unionByName(m)
    met = bloom.filter_of(written(starts.distinct(), "starts"))
    family.drop()

    narrow = written(alone.mapInArrow(_looked_at(met), _NARROW), "narrow")
    place = F.struct("key", "place")
    ways = written(narrow.groupBy("start", "way").agg(F.min(place).alias("first"), F.max(place).alias("last")), "ways")
    repeated = ways.where("first < last").select("start", "way", "first")
    later = splittable_join(narrow, repeated, ["start", "way"], "inner").where(place > F.col("first")).select("key", "version", "lo", (F.col("hi") + LENGTH).alias("hi"))

    differ = written(ways.groupBy("start").count().where("count > 1"), "differ")
    firsts = ways.join(differ, "start", "left_semi").select("start", "way", F.col("first.key").alias("key"), F.col("first.place").alias("place")).mapInArrow(_numbered, "suffix long")
    wanted = bloom.filter_of(written(firsts, "firsts"))
    often = written(differ.where(F.col("count") > many).select("start", F.lit(1).alias("often")), "often")
    around = alone.mapInArrow(_looked_at(met, wanted), _AROUND)
    around = around.join(F.broadcast(often) if often.count() <= BROADCAST_ROWS else often, "start", "left")
    around = written(around, "around")
    few = around.where("often IS NULL").drop("often").repartition("start").sortWithinPartitions("start", "key", "place").mapInArrow(_compare_sorted, _MARKS)
    marks = later.unionByName(few).unionByName(_later_strings(around.where("often = 1")))
    marks = written(marks.groupBy("key", "version").agg(F.collect_set(F.struct("lo", "hi")).alias("marks")), "marks")
    cut = _of_keys(alone, marks.select("key").distinct()).join(marks, ["key", "version"]).mapInArrow(
        _cut, "key long, version long, n_removed long, n_spans long, kept binary").withColumn("kept_sha", F.sha2("kept", 256))
    cut = cut.dropDuplicates(["key", "version"])
    if not texts:
        cut = cut.drop("kept")
    whole = F.col("copy") & (F.col("n") >= LENGTH)
    empty = F.sha2(F.lit(b""), 256)
    # short copies have nothing to remove, and long ones nothing to keep
    found = splittable_join(judged, cut, ["key", "version"], "left").select(
        F.when(F.col("key") != _NULL, F.col("key")).alias(id_column), F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha", F.lower(F.hex("sha")))).alias("kept_sha256"), *([F.col("kept")] if texts else []))
    return found


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_suffix(*(batch.column(c).to_numpy() for c in ("start", "way", "key", "place"))))], ["suffix"])
