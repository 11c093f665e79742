"""The named queries of this package, over the tables of a folder, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    byte_bpe,
    cross_polytope,
    guess_cost,
    line_rules,
    packing,
    partenum,
    pii_patterns,
    quality_classifier,
    quotations,
    term_search,
    toxicity,
    turn_repair,
    warc,
)
from tallyhouse.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    weights = quality_classifier.train(docs, _table(spark, folder, "labels"))
    scored = quality_classifier.score(spark, docs, weights)
    return scored.select(
        "doc_id",
        quality_classifier.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def _with_counts(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    base = F.col("base")

    def count(kind: str):
        return F.size(F.filter(base, lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, kinds),
        F.sha2(pii_patterns.listed(base), 256).alias("base_sha256"),
        pii_patterns.listed(F.col("found")).alias("spans"),
    )


def op3_guess_cost(spark: SparkSession, folder: str) -> DataFrame:
    return _with_counts(guess_cost.find_secrets(_table(spark, folder, "documents")), guess_cost.KINDS[:3])


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(spark, _table(spark, folder, "documents"), path)


def op5_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return cross_polytope.nearest(spark, vectors, vectors.where("vec_id % 20 = 0"))


def op6_quotations(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.in_reply_order(quotations.link_quotations(spark, _table(spark, folder, "conversations")))


def op7_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return line_rules.apply_rules(spark, docs, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_pii_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return _with_counts(pii_patterns.find_pii(spark, _table(spark, folder, "documents")), pii_patterns.KINDS)


def op9_partenum(spark: SparkSession, folder: str) -> DataFrame:
    like = partenum.Likeness(words=4, percent=85)
    return partenum.jaccard_components(spark, _table(spark, folder, "documents"), like)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(spark, _table(spark, folder, "pages"))
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
    )


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_damaged(spark, _table(spark, folder, "conversations"))


def op12_term_search(spark: SparkSession, folder: str) -> DataFrame:
    return term_search.search(spark, _table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    weights = toxicity.train(spark, docs, _table(spark, folder, "labels"))
    return toxicity.score(spark, docs, weights).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_byte_bpe,
        op3_guess_cost,
        op4_packing,
        op5_cross_polytope,
        op6_quotations,
        op7_line_frequency,
        op8_pii_patterns,
        op9_partenum,
        op10_warc,
        op11_turn_repair,
        op12_term_search,
        op13_toxicity,
    )
}
