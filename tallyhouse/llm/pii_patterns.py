"""Personal data: pattern matches seed contexts, contexts find what no pattern matches.

Emails, IP addresses, card and phone numbers are matched directly. Each match is
a seed: the two words before it, and the words on both sides, are candidate
patterns of its kind. Other identifiers in the same contexts are instances
without a kind: tokens with a digit, tokens with a mark between letters
(``john.doe[at]example``, ``@handle``), and groups of digits joined over spaces
and brackets (``(555) 123-4567``) up to the digits that a card number has. Plain
words are none, since only the context would tell them from running text. Of
found spans inside each other the longest stays. Patterns and instances form a bipartite graph, kept as
edges with no text in it. Spark scores it in rounds. Seeds and the instances
found so far are the positives of a kind, by their score; the confidence of a
pattern is their sum over the sum of all its positives, of any kind, and a part
(``unknown``) of its instances that have no kind yet. Every pattern enters every
round, so one that holds only found instances counts as well. An instance gets 1
minus the product of (1 - confidence) over its confident patterns. Patterns count
only with enough positives of the kind and a confidence above the limit; instances
above the limit are personal data of the kind ``<kind>_context``, which they keep,
and are positives from the next round on. The search ends when a round finds no
further instance: the next one would be the same.

Whole texts are scanned. Null texts are empty; repeated rows and null ids each
keep their row; an empty table gives an empty result; further columns are not
read. Seeds that several occurrences repeat count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.llm.scratch import land

KINDS = ("email", "ip", "card", "phone")
_SPAN = "array<struct<kind:string,start:int,end:int>>"
_SEEN = "array<struct<start:int,end:int,value:bigint,kind:string,patterns:array<bigint>>>"

_LOCAL = "".join(map(chr, (*range(48, 58), *range(65, 91), *range(97, 123)))) + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# A token with a digit, or a mark next to a letter; it starts after white space only, so that a long token is read once.
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@_+/\\#:=*~.()\[\]{}<>-]*+[^\x20\x09-\x0D]+")
_MARKED = re.compile(r"[0-9]|[^\W\d_][@_+/\\#:=*~.()\[\]{}<>-]+[^\W\d_]|^[@#][^\W\d_]")
# Tokens of digits and what stands between them, on one line.
_GROUP = r"[+(]*[0-9][0-9().-]*+"
_GROUPS = re.compile(rf"(?<![^\x20\x09-\x0D]){_GROUP}(?:\x20{{1,2}}{_GROUP})+(?![^\x20\x09-\x0D.,;:!?\"'\]}}>])")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'`.,;:!?()[]{}<>=“”«»"


@dataclass(frozen=True)
class Bootstrap:
    """Positives of one kind that a pattern needs, and the least confidence of patterns and instances."""

    seeds: int = 10
    confidence: float = 0.8
    #: What an instance without a kind counts against a pattern; one of another kind counts 1.
    unknown: float = 0.25
    #: Characters of context on either side, and the least length of a found identifier.
    reach: int = 200
    length: int = 5


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``local@domain``, in linear time: the local part is walked back from the @."""
    at, last = text.find("@"), 0
    while at >= 0:
        before = text[last:at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        last = domain.end() if domain else at
        if domain:
            yield start, last
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end), in order."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    spans += [
        (m.start(), 1, m.end())
        for m in _IP.finditer(text)
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split("."))
    ]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(spans)


def _joined(text: str) -> Iterator[tuple[int, int]]:
    """Spans of two or more neighbouring groups of digits, of at most as many digits as a card number."""
    for run in _GROUPS.finditer(text):
        parts, count = [], 0
        for m in [*_WORD.finditer(text, run.start(), run.end()), None]:
            digits = len(_digits(m[0])) if m else 0
            # A plus starts another number, and so does a bracket after more than a country's and area's digits.
            if not m or count + digits > 19 or m[0][0] == "+" or count >= 5 and m[0][0] == "(":
                if len(parts) > 1:
                    end = parts[-1][1]
                    tail = text[parts[0][0] : end]
                    tail = tail.rstrip("." if tail.count("(") >= tail.count(")") else ".)")
                    yield parts[0][0], parts[0][0] + len(tail)
                parts, count = [], 0
            if m:
                parts.append(m.span())
                count += digits


def _candidates(text: str, least: int) -> Iterator[tuple[int, int]]:
    """Spans of at least ``least`` characters that may be identifiers."""
    for m in _TOKEN.finditer(text):
        token = m[0].strip(_EDGE)
        if len(token) >= least and _MARKED.search(token):
            start = m.start() + len(m[0]) - len(m[0].lstrip(_EDGE))
            yield start, start + len(token)
    for start, end in _joined(text):
        if end - start >= least:
            yield start, end


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def _context(text: str, start: int, end: int, reach: int) -> list[int]:
    """Hashes of the two patterns around a span; words next to it, without digits."""
    clean = lambda words: [re.sub(r"[0-9]+", "0", w.strip(_EDGE).lower()) for w in words]
    left = clean(_WORD.findall(text[max(0, start - reach) : start])[-2:])
    right = clean(_WORD.findall(text[end : end + reach])[:1])
    found = []
    if len(left) == 2 and all(left):
        found.append(_hash(f"L {left[0]} {left[1]}"))
    if left and right and left[-1] and right[0]:
        found.append(_hash(f"M {left[-1]} {right[0]}"))
    return found


def _scan(options: Bootstrap, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    seen_type = pa.list_(
        pa.struct([
            ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64()), ("kind", pa.string()),
            ("patterns", pa.list_(pa.int64())),
        ])
    )
    for batch in batches:
        spans, seen = [], []
        for text in batch["text"]:
            text = text.as_py()
            own = base_spans(text)
            found = []
            for start, kind, end in own:
                if patterns := _context(text, start, end, options.reach):
                    found.append((start, end, _hash(text[start:end]), KINDS[kind], patterns))
            covered, k = sorted((a, b) for a, _, b in own), 0
            for start, end in sorted(_candidates(text, options.length)):
                while k < len(covered) and covered[k][1] <= start:
                    k += 1
                if k < len(covered) and covered[k][0] < end:
                    continue
                if patterns := _context(text, start, end, options.reach):
                    found.append((start, end, _hash(text[start:end]), None, patterns))
            spans.append([{"kind": KINDS[kind], "start": a, "end": b} for a, kind, b in own])
            seen.append([dict(zip(("start", "end", "value", "kind", "patterns"), x, strict=True)) for x in found])
        yield pa.record_batch(
            {"id": batch["id"], "spans": pa.array(spans, span_type), "seen": pa.array(seen, seen_type)}
        )


def _discover(spark: SparkSession, edges: DataFrame, options: Bootstrap) -> DataFrame:
    """(``value``, ``kind``) of the instances without a kind that confident patterns find."""
    edges = land(spark, edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-edges")
    # A pattern with fewer instances never has enough positives, one without open instances finds nothing.
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.count("kind").alias("seeds"))
    sizes = land(
        spark,
        sizes.where((F.col("instances") >= options.seeds) & (F.col("instances") > F.col("seeds"))).drop("seeds"),
        "pii-sizes",
    )
    edges = land(spark, edges.join(sizes, "pattern", "left_semi"), "pii-edges")
    open_edges = edges.where("kind is null").select("pattern", "value")
    count, score = F.count(F.lit(1)).alias("positives"), F.sum("score").alias("score")
    seeds = edges.where("kind is not null").withColumn("score", F.lit(1.0)).groupBy("pattern", "kind").agg(count, score)
    seeds = land(spark, seeds, "pii-seeds")
    found = land(spark, open_edges.limit(0).selectExpr("value", "'' as kind", "1.0d as score"), "pii-instances")
    while True:
        more = open_edges.join(found, "value").groupBy("pattern", "kind").agg(count, score)
        stats = seeds.union(more).groupBy("pattern", "kind").agg(
            F.sum("positives").alias("positives"), F.sum("score").alias("score")
        )
        known = stats.groupBy("pattern").agg(F.sum("positives").alias("known"), F.sum("score").alias("all"))
        against = F.col("all") + options.unknown * (F.col("instances") - F.col("known"))
        confident = (
            stats.where(F.col("positives") >= options.seeds)
            .join(known, "pattern")
            .join(sizes, "pattern")
            .withColumn("confidence", F.round(F.col("score") / against, 6))
            .where(F.col("confidence") >= options.confidence)
            .select("pattern", "kind", "confidence")
        )
        confident = land(spark, confident, "pii-patterns")
        miss = F.sum(F.log(F.lit(1.0001) - F.col("confidence")))
        instances = (
            open_edges.join(confident, "pattern")
            .groupBy("value", "kind")
            .agg(F.round(F.least(F.lit(1.0), F.lit(1.0) - F.exp(miss)), 6).alias("score"))
            .groupBy("value")
            .agg(F.max(F.struct("score", "kind")).alias("best"))
            .select("value", "best.kind", "best.score")
            .where(F.col("score") >= options.confidence)
            .join(found, "value", "left_anti")
        )
        instances = land(spark, instances, "pii-instances")
        if instances.isEmpty():
            break
        found = land(spark, found.union(instances), "pii-instances")
    return found.select("value", F.concat("kind", F.lit("_context")).alias("kind"))


def _order(kind: Column) -> Column:
    """Base kinds as listed, then the found ones."""
    ranked = [k for base in ("", "_context") for k in (f"{x}{base}" for x in KINDS)]
    return F.array_position(F.array(*map(F.lit, ranked)), kind).cast("int")


def find_pii(
    spark: SparkSession,
    docs: DataFrame,
    options: Bootstrap = Bootstrap(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: id, the columns ``keep``, ``base`` and ``found``.

    Both are sorted arrays of (start, place, kind, end); ``found`` holds the base
    spans too.
    """
    rows = docs.select(
        F.struct(F.col(id_column).alias("id"), *keep).alias("id") if keep else F.col(id_column).alias("id"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    shape = StructType([rows.schema["id"], *StructType.fromDDL(f"spans {_SPAN}, seen {_SEEN}")])
    scanned = rows.mapInArrow(partial(_scan, options), shape)
    scanned = land(spark, scanned.withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    seen = scanned.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    found = _discover(spark, seen.select("kind", "value", F.explode("patterns").alias("pattern")), options)
    # Candidates overlap only by lying inside each other.
    outer = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    more = (
        seen.where("kind is null").drop("kind").join(found, "value")
        .withColumn("reached", F.max("end").over(outer))
        .where("reached is null or end > reached")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    )

    def in_order(spans: Column) -> Column:
        return F.array_sort(
            F.transform(spans, lambda s: F.struct(s["start"], _order(s["kind"]).alias("place"), s["kind"], s["end"]))
        )

    both = F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", "more"))
    out = scanned.drop("seen").join(more, "row", "left").select(
        "id", in_order(F.col("spans")).alias("base"), in_order(both).alias("found")
    )
    if keep:
        return out.select(F.col("id.id").alias(id_column), *[F.col(f"id.`{c}`") for c in keep], "base", "found")
    return out.withColumnRenamed("id", id_column)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _masked(text: str, starts: list[int], ends: list[int], kinds: list[str]) -> str:
    pieces, at = [], 0
    for start, end, kind in zip(starts, ends, kinds, strict=True):
        if start >= at:
            pieces += (text[at:start], f"<{kind.upper()}>")
        at = max(at, end)
    pieces.append(text[at:])
    return "".join(pieces)


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; what overlaps an earlier span goes with it.

    Linear in the text: its pieces are cut in a worker and joined once. Texts without spans stay in the JVM.
    """

    @F.arrow_udf("string")
    def mask(texts: pa.Array, starts: pa.Array, ends: pa.Array, kinds: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist(), kinds.to_pylist(), strict=True)
        return pa.array([None if row[0] is None else _masked(*row) for row in rows], pa.string())

    # The worker gets no text without spans.
    found = F.when(F.size(spans) > 0, text)
    field = lambda name: F.transform(spans, lambda s: s[name])
    return F.coalesce(mask(found, field("start"), field("end"), field("kind")), text)
