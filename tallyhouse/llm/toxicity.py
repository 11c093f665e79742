"""Toxicity: FTRL-Proximal logistic regression over hashed word n-grams and skip-grams.

A text is read as its lower-cased words (runs of letters, digits and underscores).
Features are words, word pairs, and skip-grams (pairs with one or two words between),
each hashed to one of 2^bits coordinates; a coordinate counts once however often a
text holds it, so one insult weighs the same in a line and in a book. Every coordinate
has its own learning rate, from the gradients it has seen, and the L1 term holds it at
exactly zero until its summed gradient exceeds ``l1`` (McMahan et al., 2013). What is
left is a short list of coordinates and weights: compact to broadcast whatever the
corpus, since it comes from a bounded sample.

Training reads at most about ``ToxicityOptions.documents`` labelled documents, drawn by
a hash of their id: the labels are counted, thinned, and only then meet the texts.
Texts are turned into coordinates where they lie; only those travel. Each
``shard`` documents are one learner in a task of its own, and the learners' weights are
averaged by the documents they saw (the hash deals documents evenly). Scoring is one scan
without a shuffle.

Defined cases: null and empty texts, and texts without a word, score the intercept. A
document with conflicting labels counts as toxic; null labels and null ids are not learned
from, and a null id is not held out. Repeated rows of a labelled document are learned from
once each, and each gets its score. An empty table gives an empty result; without usable
labels every score is 0.5. Texts are read whole, whatever their length. Columns other than
the id and the text are neither read nor returned, so their names may clash with anything.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORDS = re.compile(r"\w+").findall
_MEMORY = 500_000  # words whose codes a task remembers
_GAPS = (1, 2, 3)  # distance of the two words of a pair; beyond 1 it is a skip-gram


@dataclass(frozen=True)
class ToxicityOptions:
    documents: int = 24_000  # bound of the sample
    shard: int = 6_000
    passes: int = 8
    bits: int = 22
    alpha: float = 8.0
    beta: float = 1.0
    l1: float = 14.0
    l2: float = 0.1


def held_out(id_column: str = "doc_id"):
    """The third of the ids that training never sees; null ids are not in it."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Coordinates:
    """The distinct hashed features of a text, ascending."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        self.codes: dict[str, int] = {}

    def _code(self, word: str) -> int:
        data = word.encode("utf-8", "surrogatepass")
        code = zlib.crc32(data) << 32 | zlib.crc32(data, 0x5BD1E995)
        if len(self.codes) < _MEMORY:
            self.codes[word] = code
        return code

    def _spread(self, values: np.ndarray) -> np.ndarray:
        values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return ((values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift

    def all(self, text: str) -> np.ndarray:
        """Coordinates as often as they occur."""
        words = _WORDS(text.lower())
        get, code = self.codes.get, self._code
        codes = np.fromiter((get(w) or code(w) for w in words), np.uint64, len(words))
        first = codes * np.uint64(0x2545F4914F6CDD1D)
        groups = [self._spread(codes)]
        groups += [self._spread(first[:-gap] + codes[gap:] + np.uint64(gap)) for gap in _GAPS if len(words) > gap]
        return np.concatenate(groups).astype(np.int64)

    def __call__(self, text: str) -> np.ndarray:
        return np.unique(self.all(text))


class Learner:
    """FTRL-Proximal for logistic loss over coordinates of value 1; the intercept comes last and has no penalty."""

    def __init__(self, options: ToxicityOptions, share: float) -> None:
        self.options = options
        size = (1 << options.bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.prior = math.log(share / (1 - share))

    def weights(self, at) -> np.ndarray:
        o, z = self.options, self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - o.l1, 0.0)
        return -shrunk / ((o.beta + np.sqrt(self.n[at])) / o.alpha + o.l2)

    def intercept(self) -> float:
        o = self.options
        return self.prior - float(self.z[-1] / ((o.beta + math.sqrt(self.n[-1])) / o.alpha + o.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w, base = self.weights(at), self.intercept()
        p = 1.0 / (1.0 + math.exp(-min(max(float(w.sum()) + base, -35.0), 35.0)))
        g = p - label
        for where, weight in ((at, w), (-1, base - self.prior)):
            n = self.n[where]
            grown = n + g * g
            self.z[where] += g - (np.sqrt(grown) - np.sqrt(n)) / self.options.alpha * weight
            self.n[where] = grown


def learn(rows: list[tuple[np.ndarray, int]], options: ToxicityOptions) -> Learner:
    """All passes over ``rows``, each in an order drawn from a fixed seed."""
    toxic = sum(label for _, label in rows)
    learner = Learner(options, min(max(toxic / len(rows), 0.01), 0.99))
    order = np.random.default_rng(1)
    for _ in range(options.passes):
        for i in order.permutation(len(rows)):
            learner.learn(*rows[i])
    return learner


def digest(at: np.ndarray) -> int:
    """What deals and orders the examples, so that training does not depend on the order of rows."""
    data = at.astype("<i4").tobytes()
    return zlib.crc32(data) << 31 | zlib.adler32(data) >> 1


def _read(options: ToxicityOptions, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = Coordinates(options.bits)
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            found = read(text.as_py()).astype(np.int32)
            yield pa.record_batch({
                "digest": pa.array([digest(found)], pa.int64()),
                "label": pa.array([label.as_py()], pa.int32()),
                "at": pa.array([found], pa.list_(pa.int32())),
            })


def _learn(options: ToxicityOptions, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("digest", "ascending"), ("label", "ascending")])
    examples = [
        (np.asarray(at.values, np.int64), label.as_py()) for at, label in zip(rows["at"], rows["label"], strict=True)
    ]
    learner = learn(examples, options)
    at = np.flatnonzero(np.abs(learner.z[:-1]) > options.l1)
    return pa.table({
        "documents": pa.array([len(examples)], pa.int64()),
        "intercept": pa.array([learner.intercept()]),
        "at": pa.array([at], pa.list_(pa.int64())),
        "weight": pa.array([learner.weights(at)], pa.list_(pa.float64())),
    })


@dataclass(frozen=True)
class Weights:
    """The coordinates that are not zero, ascending, and the intercept."""

    at: np.ndarray
    weight: np.ndarray
    intercept: float


def train(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    options: ToxicityOptions = ToxicityOptions(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Weights:
    """Weights learned from labelled documents that are not held out."""
    known = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
        .where(~held_out(id_column))
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.max(F.col(label_column).cast("int")).alias("label"))
    )
    count = known.count()
    parts = 1 << 30
    if count > options.documents:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < F.lit(int(parts * options.documents / count)))
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(known), "id")  # about options.documents rows of two numbers
    schema = "digest long, label int, at array<int>"
    read = sample.select("label", "text").mapInArrow(partial(_read, options), schema)
    shards = max(1, math.ceil(min(count, options.documents) / options.shard))

    def learn_shard(rows: pa.Table) -> pa.Table:
        return _learn(options, rows)

    schema = "documents long, intercept double, at array<bigint>, weight array<double>"
    learned = read.groupBy(F.col("digest") % shards).applyInArrow(learn_shard, schema).collect()
    total = sum(one.documents for one in learned)
    if not total:
        return Weights(np.zeros(0, np.int64), np.zeros(0), 0.0)
    at = np.concatenate([np.asarray(one["at"], np.int64) for one in learned])
    shares = np.concatenate([np.asarray(one.weight, float) * one.documents / total for one in learned])
    at, where = np.unique(at, return_inverse=True)
    return Weights(at, np.bincount(where, shares, len(at)), sum(one.intercept * one.documents for one in learned) / total)


def _score(shared, options: ToxicityOptions, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, read = shared.value, Coordinates(options.bits)
    dense = np.zeros(1 << options.bits, np.float32)
    dense[model.at] = model.weight
    for batch in batches:
        scores = np.empty(batch.num_rows)
        for i, text in enumerate(batch["text"]):
            found = read.all(text.as_py())
            found = np.unique(found[dense[found] != 0])
            scores[i] = model.intercept + model.weight[np.searchsorted(model.at, found)].sum()
        scores = 1.0 / (1.0 + np.exp(-np.clip(scores, -35.0, 35.0)))
        yield pa.record_batch({"id": batch["id"], "score": pa.array(scores)})


def score(
    spark: SparkSession,
    docs: DataFrame,
    weights: Weights,
    options: ToxicityOptions = ToxicityOptions(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Id and ``score`` of every document; 1 is toxic."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(partial(_score, spark.sparkContext.broadcast(weights), options), schema)
    return scored.select(F.col("id").alias(id_column), "score")
