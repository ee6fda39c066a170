"""The pipeline against plain Python on a small table."""

from __future__ import annotations

import pandas as pd
import test_exact
import test_search
import test_similarity

import corpus_pipeline
from salesmart.llm import queries

TABLES = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = pd.read_parquet(f"{TABLES}/documents.parquet")
    said = {r.doc_id: r for r in queries.op3_language_id(spark, TABLES).collect()}
    rows = [(int(i), t) for i, t in zip(docs.doc_id, docs.text, strict=True) if said[i].lang_pred != "und" and not said[i].ambiguous]
    kept = {r[0] for r in test_exact.brute(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    kept = {r[0] for r in test_similarity.brute(rows) if r[0] == r[2]}
    rows = [r for r in rows if r[0] in kept]
    bench = pd.read_parquet(f"{TABLES}/benchmark.parquet")
    kept = {r[0] for r in test_search.brute(rows, list(zip(bench.item_id, bench.text, strict=True))) if r[2] == 0}
    out = corpus_pipeline.run(spark, TABLES).toPandas()
    assert set(out.doc_id) == kept
    assert (out.groupby("doc_id").length.sum() == out.groupby("doc_id").doc_tokens.first()).all()


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, TABLES).dtypes == docs.dtypes
