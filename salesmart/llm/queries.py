"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import chat, decontamination, exact, language, licenses, packing, pii, quality, resampling, similarity, suffixes, urls, whitening
from salesmart.llm.fixed import table, tokenizer_path
from salesmart.llm.shipping import ship

#: Rules for op8.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: A page counts as a good outcome if its text without tags has so many characters and such a share of the page.
GOOD_TEXT, GOOD_SHARE = 400, 0.25


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    model = language.train(docs.where(~out))
    said = language.identify(docs, model, keep=["doc_id"])
    return said.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.jaccard_groups(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("pii", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counted = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counted, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed("pii").alias("spans"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    model = quality.train(docs, labels.where(~out))
    return quality.score(docs, model, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.char_length(F.regexp_replace(F.regexp_replace("html", r"<[^>]*>", ""), r"[ \t\n\r]+", ""))
    good = ((text >= GOOD_TEXT) & (text >= GOOD_SHARE * F.char_length("html"))).cast("int")
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", good.alias("good")), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("n").alias("n_labelled"))


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = chat.gather_turns(table(spark, sf_dir, "conversations"))
    pairs = whole.select("conv_id", F.col("turns").alias("chosen"), chat.reused_reply(F.col("turns")).alias("rejected"))
    return chat.format_preferences(pairs, "conv_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")}).drop("matches")


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: shipped(f) for f in (
        op1_packing, op2_suffix_dedup, op3_language_id, op4_decontamination, op5_exact_dedup, op6_jaccard_join, op7_pii, op8_url_filter, op9_quality, op10_preferences,
        op11_whitening, op12_resampling, op13_license_scan)}
