"""Quality rules that look across documents: how often a host repeats a line.

Lines are normalised (lower case, white space collapsed) and hashed. Per host,
the distinct documents that hold a line are counted; documents with the same
sequence of lines are one document, so copies do not make their own text look
like boilerplate. A line is frequent when more than ``share`` of the host's documents
hold it, and at least ``min_documents``, a floor of a few that says what a repetition is;
so hosts of any size are judged alike. Frequent lines are removed; a document is depleted, and
rejected, when less than ``min_left`` of its words or fewer than ``min_words`` remain.
Rejected too is one that fails the rules on its own text: fewer than ``min_words`` words,
or more than ``max_repeated`` of them inside repeated 3-word windows.

Everything is built-in expressions. Texts never travel for the counting: a
document sends one 64-bit hash per line, and counts are summed before each
shuffle. The scan is written once, with a row id that stays; the frequent lines
meet the documents' line hashes in an equi-join whose hot keys adaptive
execution splits.

Null texts have no lines and no words, and are rejected; a null host is a host
of its own; repeated rows and null ids each keep their row; an empty table gives
an empty result; further columns pass through ``apply_rules`` unchanged, except
that a measure takes the place of an input column of its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import land

_SPACE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_WORD = r"([^\x20\x09-\x0D]+)"
_ROW = "__row"
#: What ``apply_rules`` adds.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "removed_lines",
    "base_failed", "kept",
)


@dataclass(frozen=True)
class LineLimits:
    """Shares in whole percent, of documents or words; a limit counts as kept at the value itself."""

    min_documents: int = 5
    share: int = 5
    min_left: int = 30
    min_words: int = 50
    max_repeated: int = 50


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def _lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(_SPACE))) > 0)


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more."""

    def in_order(windows: Column) -> Column:
        last = F.size(windows) - 1

        def repeats(j: Column) -> Column:
            own = windows[j]["hash"]
            return ((j > 0) & (windows[F.greatest(j - 1, F.lit(0))]["hash"] == own)) | (
                (j < last) & (windows[F.least(j + 1, last)]["hash"] == own)
            )

        starts = F.sort_array(
            F.transform(F.filter(F.sequence(F.lit(0), last), repeats), lambda j: windows[j]["at"])
        )
        return F.aggregate(
            starts,
            F.struct(F.lit(-3).alias("at"), F.lit(0).alias("words")),
            lambda seen, at: F.struct(
                at.alias("at"), (seen["words"] + F.least(F.lit(3), at - seen["at"])).alias("words")
            ),
            lambda seen: seen["words"],
        )

    def of_hashes(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, at: F.struct(h.alias("hash"), at.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(windows, in_order))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])
    )
    return F.when(F.size(words) < 4, 0).otherwise(_let(hashes, of_hashes))


def _measured(docs: DataFrame, text_column: str, host_column: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` as ``__doc``, the measures, and the hashes and sizes of the lines."""
    text = F.col("__text")
    spaceless = F.translate(text, _SPACE, "")
    return (
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__doc"),
            F.coalesce(text_column, F.lit("")).alias("__text"),
            F.col(host_column).alias("__host"),
        )
        .withColumn("__words", F.regexp_extract_all("__text", F.lit(_WORD), 1))
        .withColumn("__lines", _lines(F.col("__text")))
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.length(spaceless).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("n_repeat_words", _repeated_words(F.col("__words")).cast("long"))
        .withColumn("__normal", F.transform("__lines", _normal))
        .withColumn("__hashes", F.transform("__normal", lambda line: F.xxhash64(line)))
        .withColumn(
            "__sizes",
            F.transform("__normal", lambda line: F.length(line) - F.length(F.translate(line, " ", "")) + 1),
        )
        .withColumn(_ROW, F.monotonically_increasing_id())
        .drop("__text", "__words", "__lines", "__normal")
    )


def frequent_lines(measured: DataFrame, limits: LineLimits) -> DataFrame:
    """(``__host``, ``__hash``) of the lines above the limits."""
    distinct = measured.select("__host", "__hashes").distinct()
    totals = distinct.groupBy("__host").agg(F.count(F.lit(1)).alias("documents"))
    counts = (
        distinct.select("__host", F.explode(F.array_distinct("__hashes")).alias("__hash"))
        .groupBy("__host", "__hash")
        .agg(F.count(F.lit(1)).alias("holders"))
        .where(F.col("holders") >= limits.min_documents)
    )
    same_host = counts["__host"].eqNullSafe(totals["__host"])
    return counts.join(totals, same_host).where(F.col("holders") * 100 > F.col("documents") * limits.share).select(
        counts["__host"], "__hash"
    )


def apply_rules(
    spark: SparkSession,
    docs: DataFrame,
    limits: LineLimits = LineLimits(),
    *,
    text_column: str = "text",
    host_column: str = "source",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` and the columns ``MEASURES``.

    ``removed_lines`` holds hashes, null where no line goes.
    """
    keep = docs.columns if keep is None else keep
    measured = land(spark, _measured(docs, text_column, host_column, keep), "line-rules")
    # Written, so the planner knows their size: few enough are broadcast, and no line is shuffled for them.
    frequent = land(spark, frequent_lines(measured, limits), "frequent-lines")
    lines = measured.select(_ROW, "__host", F.explode(F.arrays_zip("__hashes", "__sizes")).alias("line")).select(
        _ROW, "__host", F.col("line.__hashes").alias("__hash"), F.col("line.__sizes").alias("size")
    )
    removed = (
        lines.join(
            frequent,
            (lines["__hash"] == frequent["__hash"]) & lines["__host"].eqNullSafe(frequent["__host"]),
        )
        .groupBy(_ROW)
        .agg(F.sum("size").alias("n_removed_words"), F.collect_set(lines["__hash"]).alias("removed_lines"))
    )
    # Likewise: while the rows that lose lines fit Spark's threshold, no text is shuffled to meet them.
    removed = land(spark, removed, "removed-lines")
    too_short = F.col("n_words") < limits.min_words
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeated
    left = F.col("n_words") - F.col("n_removed_words")
    own = [F.col(f"__doc.`{c}`").alias(c) for c in keep if c not in MEASURES]
    return (
        measured.drop("__hashes", "__sizes", "__host")
        .join(removed, _ROW, "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
        .withColumn("base_failed", too_short | repetitive)
        .withColumn(
            "kept",
            ~F.col("base_failed") & (left * 100 >= F.col("n_words") * limits.min_left) & (left >= limits.min_words),
        )
        .select(*own, *MEASURES)
    )


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose hashes ``removed`` lists; a null list removes none."""
    kept = F.filter(
        F.split(text, "\n", -1), lambda line: ~F.array_contains(removed, F.xxhash64(_normal(line)))
    )
    return F.when(removed.isNull(), text).otherwise(F.array_join(kept, "\n"))
