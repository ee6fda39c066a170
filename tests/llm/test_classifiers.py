"""Language and quality: held-out accuracy, codes, odd rows."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SMALL, collected, frame  # noqa: F401
from pyspark.sql import functions as F

from salesmart.llm import language, quality, queries

TABLES = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 20])
def test_codewords_differ(n):
    code = language.codewords(n).astype(int)
    far = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
    assert min(far) >= (2 ** (n - 2) if n <= 5 else code.shape[1] // 4)
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang")
    said = queries.op3_language_id(spark, TABLES).join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(said) > 100
    assert sum(r.lang == r.lang_pred for r in said) > 0.98 * len(said)
    assert all(0 <= r.score <= 1 for r in said)


def test_odd_texts_have_a_language(spark, frame):
    train = frame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)] * 5, "text string, lang string")
    model = language.train(train)
    assert model.languages == ["de", "en"]
    docs = frame([(1, None, 1), (2, "", 1), (3, " 123 !² ", 1), (4, "THE DOG", 1), (4, "THE DOG", 1), (None, "und die", 1), (5, "猫", 1), (6, "the cat " * 50_000, 1)], "doc_id long, text string, score int")
    said = collected(language.identify(docs, model, keep=["doc_id"]))
    assert [r[:2] for r in said] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, said[5][1]), (6, "en"), (None, "de")]
    assert said[5][3] and said[0][2] == 0
    assert language.train(train.where("lang = 'none'")) is None
    assert {r.lang_pred for r in language.identify(docs, None, keep=["doc_id"]).collect()} == {"und"}
    assert language.identify(docs.limit(0), model, keep=["doc_id"]).count() == 0
    one = language.train(train.where("lang = 'en'"))
    assert {r.lang_pred for r in language.identify(docs, one, keep=["doc_id"]).collect()} == {"und", "en"}


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", "quality")
    said = queries.op9_quality(spark, TABLES).join(labels, "doc_id").where("held_out").collect()
    assert len(said) > 50
    assert sum(r.predicted == r.quality for r in said) > 0.95 * len(said)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in said)


def test_quality_of_odd_texts(spark, frame):
    docs = frame([(1, None, 0), (2, "", 0), (3, "ab", 0), (3, "ab", 0), (None, "!!! ???", 0), (4, "good words " * 30_000, 0), (5, "AA!! BB!! CC!!", 0)], "doc_id long, text string, score int")
    labels = frame([(4, 1), (5, 0), (5, 0), (None, 1), (99, 1), (3, None), (2, 7)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    said = {r.doc_id: r.score for r in quality.score(docs, model, keep=["doc_id"]).collect()}
    assert len(said) == 6 and all(0 <= s <= 1 for s in said.values())
    assert said[1] == said[2]
    assert said[4] > said[5]
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing, keep=["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.limit(0), model, keep=["doc_id"]).count() == 0


def test_neighbours_are_exact():
    rng = np.random.default_rng(0)
    rows, labels = rng.random((60, quality.FEATURES)).astype(np.float32), rng.integers(0, 2, 60)
    model = quality.Model(np.ones(quality.FEATURES), rows, labels, np.ones(2))
    found = rng.random((9, quality.FEATURES)).astype(np.float32)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    for x, said in zip(found, model.score(found), strict=True):
        near = model.known @ unit(unit(x) @ model.basis)
        best = np.argsort(-near)[: quality.NEIGHBOURS]
        vote = np.exp(quality.SHARPNESS * (near[best] - 1))
        assert said == pytest.approx((vote * labels[best]).sum() / vote.sum(), abs=1e-4)


def test_small_tables(spark):
    assert queries.op3_language_id(spark, SMALL).count() == queries.op9_quality(spark, SMALL).count() == 200


def test_decoding_equals_plain_python():
    """Language by language and bit by bit: the codeword with the least trust-weighted logistic loss, its share of the likelihood, the flag."""
    import math

    import pyarrow as pa

    rng = np.random.default_rng(4)
    model = language.Model(["a", "b", "c", "d"], rng.integers(0, 40, (4, language.FEATURES)).astype(float))
    texts = ["the cat", "der Hund und die Katze", "x", "été à la plage", "", "123 !!", "word " * 400]
    data, at = language.arrays.texts(pa.array(texts, pa.string()))
    best, share, close, seen = model.decode(data, at)
    found = [[] for _ in texts]
    for feature, row in language.grams(data, at):
        for f, r in zip(feature.tolist(), row.tolist(), strict=True):
            found[r].append(f)
    for k, own in enumerate(found):
        evidence = min(len(own), language.EVIDENCE)
        margins = [sum(float(model.weights[f, b]) for f in own) * evidence / max(1, len(own)) for b in range(model.code.shape[1])]
        losses = [sum(t * math.log1p(math.exp(-abs(m * c))) + t * max(0.0, -m * c) for m, c, t in zip(margins, word, model.trust, strict=True)) for word in model.code.tolist()]
        ranked = sorted(losses)
        assert seen[k] == len(own)
        assert losses[best[k]] == pytest.approx(ranked[0], rel=1e-4, abs=1e-6)
        assert share[k] == pytest.approx(1 / sum(math.exp(ranked[0] - x) for x in ranked), rel=1e-2)
        if abs(ranked[1] - ranked[0] - language.CLOSE * max(evidence, 1)) > 1e-3:
            assert close[k] == (ranked[1] - ranked[0] < language.CLOSE * max(evidence, 1))


def test_quality_learns_the_same_from_repeated_ids(spark):
    rows = [(1, "Good words stand here."), (1, "bad bad bad"), (1, None), (2, "zzz zzz 111"), (2, "zzz zzz 111"), (3, "More good words.")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    models = [quality.train(spark.createDataFrame(own, "doc_id long, text string").repartition(parts), labels) for own, parts in ((rows, 1), (rows[::-1], 4))]
    assert np.array_equal(models[0].known, models[1].known) and np.array_equal(models[0].labels, models[1].labels)


def test_quality_vectors_stay_off_the_driver(spark):
    n = 400
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.sha2(F.concat("id", F.lit(f" {k}")), 256) for k in range(8))).alias("text")).repartition(3)
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("quality"))
    tracemalloc.start()
    model = quality.train(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * quality.FEATURES * 4  # less than the vectors of the labelled rows alone
    data, at = quality.arrays.texts(pa.array([r.text for r in docs.orderBy("doc_id").collect()], pa.string()))
    x, y = quality.features(data, at), (np.arange(n) % 3 == 0).astype(int)
    whole = quality.Model(model.idf, x, y, np.ones(2))
    assert np.array_equal(model.labels, whole.labels) and np.allclose(model.known @ model.known.T, whole.known @ whole.known.T, atol=1e-3)
    assert np.allclose(model.score(x[:50]), whole.score(x[:50]), atol=1e-3)
