"""Whitened components against exact fractions and the library's double eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from llm_fixtures import SMALL, frame  # noqa: F401
from pyspark.sql import functions as F

from salesmart.llm import queries, whitening

KIND = "vec_id long, embedding array<float>"


def brute(rows):
    """n, S, deviations and the covariance, in exact fractions, of rows of floats."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in row] for row in rows]
    n, d = len(x), len(x[0])
    sums = [sum(row[k] for row in x) for k in range(d)]
    centred = [[Fraction(row[k]) - Fraction(sums[k], n) for k in range(d)] for row in x]
    covariance = [[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)]
    return n, [sum((n * row[k] - sums[k]) ** 2 for k in range(d)) for row in x], np.array([[float(v) for v in r] for r in centred]), np.array(covariance)


def checked(found, rows, ids, components=32):
    n, deviations, centred, covariance = brute(rows)
    d = len(covariance)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_id) == set(ids)
    k = min(components, d)
    got = np.array([[by_id[i][c].whitened for c in range(1, k + 1)] for i in ids])
    for i, deviation in zip(ids, deviations, strict=True):
        assert sorted(by_id[i]) == list(range(1, k + 1))
        assert all(r.n == n and int(r.deviation) == deviation for r in by_id[i].values())
    for c in range(k):
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        got_c = got[:, c] * np.sign(got[:, c] @ want)
        assert np.abs(got_c - want).max() < 1e-8, c
        assert by_id[ids[0]][c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-12)
    whole = np.cov(got.T, bias=True).reshape(k, k)
    assert np.abs(whole - np.eye(k)).max() < 1e-9
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-9


def test_equals_brute_force(frame):
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(300, 6)) * [5, 3, 3, 2, 1, 0.5] + [0, 100, -7, 0, 1e4, 0.1]).astype(np.float32).tolist()
    found = whitening.whiten(frame(list(enumerate(rows)), KIND)).collect()
    checked(found, rows, range(300))
    checked(whitening.whiten(frame(list(enumerate(rows)), KIND), components=2).collect(), rows, range(300), 2)


def test_query_equals_brute_force(spark):
    found = queries.op11_whitening(spark, SMALL).collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    checked(found, [r.embedding for r in given], [r.vec_id for r in given])
    assert dict(queries.op11_whitening(spark, SMALL).dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}


def test_unusable_vectors_are_dropped(frame):
    rng = np.random.default_rng(2)
    good = [(k, [float(v) for v in rng.normal(size=3)]) for k in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, math.nan, 2.0]), (104, [math.inf, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0]), (107, [1.0] * 4)]
    extra = frame([(*r, "x", 1) for r in good + bad], KIND + ", v string, n int")
    found = whitening.whiten(extra).collect()
    checked(found, [r[1] for r in good], range(40))


def test_repeated_rows_and_null_ids(frame):
    rows = [(1, [0.0, 1.0])] * 3 + [(None, [2.0, 1.5])] * 2 + [(4, [1.0, 7.0])]
    found = whitening.whiten(frame(rows, KIND)).collect()
    assert len(found) == 12 and {r.n for r in found} == {6}
    assert sum(r.vec_id is None for r in found) == 4


def test_no_rows_and_no_variance(frame):
    assert whitening.whiten(frame([], KIND)).count() == 0
    assert whitening.whiten(frame([(1, None), (2, [math.nan])], KIND)).count() == 0
    one = whitening.whiten(frame([(1, [1.0, 2.0])], KIND)).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in sorted(one, key=lambda r: r.component)] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]


def test_components_without_variance_have_no_scale(frame):
    rows = [(k, [float(k), 2.0 * k, 5.0]) for k in range(10)]
    found = sorted(whitening.whiten(frame(rows, KIND)).collect(), key=lambda r: (r.component, r.vec_id))
    assert all(r.whitened is not None for r in found[:10]) and all(r.whitened is None for r in found[10:])
    assert found[0].explained == pytest.approx(1) and found[0].identity_error < 1e-9


def test_large_entries_stay_exact(frame):
    rows = [[float(np.float32(v)) for v in row] for row in ([3e12, 1.0], [1e12, 2.0], [2.5e12, -4.0], [7e11, 0.5])]
    found = whitening.whiten(frame(list(enumerate(rows)), KIND), components=1).collect()
    _, deviations, _, _ = brute(rows)
    assert {r.vec_id: int(r.deviation) for r in found} == dict(enumerate(deviations))


def with_spectrum(values, seed=3):
    """A symmetric matrix of wide floats with (nearly) these eigenvalues: reflections of a diagonal one, in wide floats."""
    rng = np.random.default_rng(seed)
    out = np.diag(np.array(values, np.longdouble))
    for _ in range(3):
        v = rng.normal(size=len(values)).astype(np.longdouble)
        h = np.eye(len(values), dtype=np.longdouble) - 2 * np.outer(v, v) / (v @ v)
        out = h @ out @ h
    return (out + out.T) / 2


@pytest.mark.parametrize("spectrum", [
    [9.0, 5.0, 2.0, 1.0], [5.0, 5.0, 5.0, 1.0], [5.0, 5.0 - 1e-9, 5.0 - 2e-9, 1.0, 0.25], [1.0, 1.0 - 1e-12, 0.5, 0.5 - 1e-10, 1e-6], [3.0] * 6, [1.0, 0.0, 0.0], [0.0, 0.0], [4.0],
    [1 + 1e-7 * k for k in range(30)], list(np.geomspace(1, 1e-9, 25))])
def test_refined_vectors_beat_doubles(spectrum):
    a = with_spectrum(spectrum)
    values, x = whitening.refined_eigenvectors(a)
    wanted = np.sort(np.array(spectrum, np.longdouble))[::-1]
    size = max(1e-300, float(wanted[0]))
    assert np.abs(values - wanted).max() <= 1e-17 * size * len(spectrum)
    assert np.abs(x.T @ x - np.eye(len(spectrum))).max() < 1e-17 * len(spectrum)
    assert np.abs(a @ x - x * values).max() <= 2e-17 * size * len(spectrum)


def test_close_but_distinct_eigenvalues_keep_their_vectors():
    """Float32 vectors cannot tell these apart; the refined ones agree with each pair's own eigenvector."""
    values = [2.0, 2.0 - 1e-9, 1.0]
    a = with_spectrum(values, 5)
    _, x = whitening.refined_eigenvectors(a)
    turned = x.T @ a @ x
    assert abs(turned[0, 1]) < 1e-18 and np.diag(turned)[0] - np.diag(turned)[1] == pytest.approx(1e-9, rel=1e-6)


def test_usable_is_null_safe(frame):
    said = frame([(1, None), (2, [1.0]), (3, [None])], KIND).select("vec_id", whitening.usable(F.col("embedding")).alias("u")).collect()
    assert {r.vec_id: r.u for r in said} == {1: False, 2: True, 3: False}
