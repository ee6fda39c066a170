"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SMALL, frame  # noqa: F401
from pyspark.sql import functions as F

from salesmart.llm import arrays, checksums, queries, resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def grams(text):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def buckets(text):
    return [zlib.crc32(g.encode()) % 10_000 for g in grams(text)]


def brute(docs, items):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, text in docs:
        np.add.at(s, buckets(text), 1)
    for _, text in items:
        np.add.at(t, buckets(text), 1)
    gain = [math.floor(1000 * math.log((float(b) + 1) * (float(t.sum()) * 0 + float(s.sum()) + 10_000) / ((float(a) + 1) * (float(t.sum()) + 10_000)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    rows = []
    for i, text in docs:
        weight = sum(gain[b] for b in buckets(text))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words(text)), len(grams(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return rows, [(r[0], r[4]) for r in able[: len(able) * 5 // 100]]


def checked(found, docs, items):
    rows, drawn = brute(docs, items)
    got = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in found]
    assert sorted(got, key=repr) == sorted(map(tuple, rows), key=repr)
    ranked = sorted((r for r in found if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == drawn


def sample(n=400):
    rng = random.Random(4)
    vocabulary = ["a", "Bb", "çé", "d4", "É", "x" * 70, "y" * 64, "z" * 63, "w" * 300]
    text = lambda k, own=vocabulary: " ,".join(rng.choice(own) for _ in range(k))
    docs = [(k, text(rng.randrange(0, 60))) for k in range(n)] + [(n, None), (n + 1, ""), (n + 2, "... !"), (None, text(30)), (None, None), (7, text(40)), (n + 3, text(30_000)), (n + 4, "q" * 200_000)]
    docs += [(n + 10, "same words " * 12)] * 60
    return docs, [(k, text(25, vocabulary[:4])) for k in range(10)] + [(90, None), (91, "")]


def test_equals_brute_force(frame):
    docs, items = sample()
    checked(resampling.resample(frame(docs), frame(items, "item_id long, text string", 1)).collect(), docs, items)


def test_query_equals_brute_force(spark):
    read = lambda name: [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").select("doc_id" if name == "documents" else "item_id", "text").collect()]
    found = queries.op12_resampling(spark, SMALL)
    assert {c: k for c, k in found.dtypes if c != "n_words"} == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    checked(found.collect(), read("documents"), read("benchmark"))


def test_repeated_rows_are_drawn_one_by_one(frame):
    docs = [(1, "w " * 25)] * 100 + [(None, "w " * 25)] * 40
    found = resampling.resample(frame(docs), frame([(1, "w")], "item_id long, text string")).collect()
    ranks = [r.rank for r in found if r.rank is not None]
    assert sorted(ranks) == list(range(1, 8)) and len(found) == 140


def test_empty_tables_and_extra_columns(frame):
    none = frame([], "item_id long, text string")
    assert resampling.resample(frame([]), none).count() == 0
    docs = frame([(k, "a b c " * 10, 3, "x") for k in range(40)], "doc_id long, text string, score int, row string")
    found = resampling.resample(docs, none).collect()
    assert len(found) == 40 and sorted(r.rank for r in found if r.rank) == [1, 2]
    assert {r.rank for r in resampling.resample(docs, none, least_words=31).collect()} == {None}


def test_ids_of_any_type(frame):
    docs = [(f"id{k}", "a b c " * 10) for k in range(60)]
    found = resampling.resample(frame(docs, "doc_id string, text string"), frame([(1, "a")], "item_id long, text string")).collect()
    noise = lambda i: math.floor(-1000 * math.log(-math.log((int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296)))
    assert [r.doc_id for r in sorted((r for r in found if r.rank), key=lambda r: r.rank)] == sorted((i for i, _ in docs), key=lambda i: (-noise(i), i))[:3]


@pytest.mark.parametrize("k", [1, 2, 499, 500])
@pytest.mark.parametrize("pivots", [1, 15])
def test_quickselect(spark, k, pivots):
    rng = random.Random(k)
    rows = [(rng.randrange(5), i % 7 == 0, None if i % 7 == 0 else rng.randrange(9), rng.randrange(3), i) for i in range(500)]
    keys = spark.createDataFrame(rows, "down long, unnamed boolean, id long, tie long, row long").repartition(5)
    keys = keys.select("down", F.struct("down", "unnamed", "id", "tie", "row").alias("key"))
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0, r[3], r[4]))
    assert resampling.kth_key(keys, k, pivots=pivots) == order[k - 1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=200), min_size=1, max_size=12))
def test_checksums(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    sums = checksums.span_sums(data, starts, ends)
    assert sums.tolist() == [zlib.crc32(p) for p in parts]
    if len(parts) > 1:
        assert checksums.joined(sums[:-1], sums[1:], (ends - starts)[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def test_checksums_of_long_spans():
    a, b = b"abc", b"x" * 5_000_017
    assert checksums.joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)])).tolist() == [zlib.crc32(a + b)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é.1\x00", max_size=30), max_size=6))
def test_features(texts):
    import pyarrow as pa

    found = resampling.features(*arrays.texts(pa.array(texts, pa.string())))
    assert found.words.tolist() == [len(words(t)) for t in texts]
    for k, t in enumerate(texts):
        assert sorted(found.buckets[found.rows == k].tolist()) == sorted(buckets(t))
