"""A corpus pipeline of the text operators: each stage reads what the one before it kept, from a table.

Stages, in order: documents whose language cannot be told go; of equal texts one stays; of each group of near copies one
stays; documents with benchmark passages go; what is left is packed into windows. All but the last stage return rows
of ``documents`` with their columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontamination, exact, language, packing, similarity
from salesmart.llm.fixed import table, tokenizer_path
from salesmart.llm.queries import held_out
from salesmart.llm.shipping import ship
from salesmart.llm.storage import unused, written



def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the codewords tell: ``und`` and ambiguous ones go. Learns from the rows that are not held out."""
    model = language.train(docs.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    said = language.identify(docs, model, keep=docs.columns, names=(p := unused(docs, "lang_pred"), s := unused(docs, "lang_score"), a := unused(docs, "lang_ambiguous")))
    return said.where((F.col(p) != language.UNKNOWN) & ~F.col(a)).drop(p, s, a)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similarity.keep_one(docs)


def no_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any benchmark passage."""
    names = tuple(unused(docs, n) for n in decontamination.NAMES)
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns, names=names)
    return found.where(F.col(names[1]) == 0).drop(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language), ("exact dedup", no_exact_copies), ("near dedup", no_near_copies),
    ("decontamination", no_benchmark_text), ("packing", packed),
]

#: SQL expresses neither the classifier nor the tokenizer; tests compare run() with plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of ``documents``."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
