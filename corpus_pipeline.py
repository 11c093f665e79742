"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Every stage takes and returns the columns of ``documents``; the last one returns
the pieces of the packed sequences. Columns beyond those pass through, rows with
null or empty texts are judged like any other (no words: rejected by the quality
rules), and an empty table gives an empty result.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import line_rules, packing, partenum, pii_patterns, quality_classifier
from tallyhouse.llm.scratch import Steps, land, release

#: Documents with a lower score are rejected.
LEAST_QUALITY = 0.3

_steps = Steps()


def _stage(step):
    """A stage that first deletes the scratch tables of the stages before, whose results are written by then."""

    @wraps(step)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return _steps.run(spark, docs, lambda: step(spark, docs, sf_dir))

    return staged


def _whole(docs: DataFrame) -> DataFrame:
    """The id, the text, and the row as ``doc``."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _rewritten(rows: DataFrame, columns: list[str], text) -> DataFrame:
    """The documents of ``rows`` with another text and its length."""
    rows = rows.withColumn("__text", text)
    new = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return rows.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns])


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, trained on the labelled documents, rejects."""
    weights = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")
    scored = quality_classifier.score(spark, docs.select("doc_id", "text", others), weights, keep=("doc", "text"))
    kept = scored.where(F.col("score") >= LEAST_QUALITY)
    return kept.select(*[F.col("text" if c == "text" else f"doc.`{c}`").alias(c) for c in docs.columns])


@_stage
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that too many documents of a source share; drop depleted, short and repetitive documents."""
    judged = line_rules.apply_rules(spark, _whole(docs).withColumn("source", F.col("doc.source")))
    text = line_rules.without_lines(F.col("text"), F.col("removed_lines"))
    return _rewritten(judged.where("kept"), docs.columns, text)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of similar ones (5-word shingles, 0.8)."""
    return partenum.keep_one(spark, docs)


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    found = pii_patterns.find_pii(spark, _whole(docs), keep=("doc",))
    return _rewritten(found, docs.columns, pii_patterns.masked(F.col("doc.text"), F.col("found")))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("packing", pack),
]

#: No SQL for the trained classifier; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from the written result of the one before."""
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), ()
    for _, stage in STAGES[:-1]:
        docs = land(spark, stage(spark, docs, sf_dir), "pipeline")
        release(spark, *done)
        done = (docs,)
    return STAGES[-1][1](spark, docs, sf_dir)
