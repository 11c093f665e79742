"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text is read as words (runs of letters, digits, or punctuation). Features are
hashed: words, word pairs, and pairs and triples of word shapes (case, digits,
the punctuation itself, "same as the word before"), each group weighted by one
over its size, so a score does not depend on the length of the text. Weights are
learned with FTRL-Proximal (McMahan et al., 2013), whose per-coordinate rates
and L1 term leave most weights at zero; a score is one sparse dot product.

Training reads at most about ``TrainOptions.documents`` labelled documents,
drawn by a hash of their id: the labels are counted, thinned, and only then meet
the texts. The sample is dealt by a hash of the id over a fixed number of shards;
each makes its passes in one task over feature arrays of bounded size, and its
weight vector is shuffled in parts. A part is averaged over the shards where it
lands, so the driver gets one vector (2^bits numbers) whatever the input, the number
of shards and the number of partitions. Scoring is one scan without a shuffle.

Null and empty texts get the score of no features. A document with conflicting
labels counts as low quality; null labels and ids are not learned from. Repeated
rows each get their score; an empty table gives an empty result, and without
labels every score is the prior 0.5. Further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

_WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+").findall
_MEMORY = 100_000  # words whose codes a task remembers
_SLICE = 1000  # scored rows that return to the JVM together
_PART = 1 << 14  # weights that are averaged together
_ROOM = 4  # partitions for each shard, so that few shards wait for another one in the same task


@dataclass(frozen=True)
class TrainOptions:
    documents: int = 24_000
    shards: int = 8
    passes: int = 4
    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01
    scale: float = 8.0


def held_out(id_column: str = "doc_id"):
    """The fifth of the ids that training never sees; null ids are not in it."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Features:
    """Hashed features of texts."""

    def __init__(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.codes: dict[str, int] = {}

    def _code(self, word: str) -> int:
        """Word hash in the upper half, shape hash in the lower."""
        if word[0].isalpha():
            shape = "X" if word.isupper() and len(word) > 1 else "Xx" if word[0].isupper() else "x"
        elif word[0].isdigit():
            shape = f"9{min(len(word), 5)}"
        else:
            shape = word[:3]
        code = zlib.crc32(word.encode("utf-8", "surrogatepass")) << 32 | zlib.crc32(shape.encode("utf-8", "surrogatepass"))
        if len(self.codes) < _MEMORY:
            self.codes[word] = code
        return code

    def __call__(self, text: str) -> list[np.ndarray]:
        """Positions in the weight vector, group by group, as often as they occur."""
        words = _WORDS(text)
        if not words:
            return []
        get, code = self.codes.get, self._code
        codes = np.fromiter((get(w) or code(w) for w in words), np.uint64, len(words))
        word, shape = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
        shape[1:][codes[1:] == codes[:-1]] = 7
        groups = [self._mix(word, 1)]
        if len(words) > 1:
            groups.append(self._mix(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:], 2))
            pairs = shape[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + shape[1:]
            groups.append(self._mix(pairs, 3))
            if len(words) > 2:
                groups.append(self._mix(pairs[:-1] * np.uint64(0x9E3779B97F4A7C15) + shape[2:], 4))
        return groups

    def _mix(self, values: np.ndarray, group: int) -> np.ndarray:
        values = (values + np.uint64(group)) * np.uint64(0xD6E8FEB86659FD93)
        return ((values ^ (values >> np.uint64(32))) & self.mask).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-Proximal for logistic loss; the last coordinate is the intercept."""

    def __init__(self, options: TrainOptions) -> None:
        self.options = options
        self.z = np.zeros((1 << options.bits) + 1)
        self.n = np.zeros((1 << options.bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        o, z = self.options, self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - o.l1, 0.0)
        return -shrunk / ((o.beta + np.sqrt(self.n[at])) / o.alpha + o.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.options.alpha * w
        self.n[at] = grown


def _sparse(groups: list[np.ndarray], options: TrainOptions) -> tuple[np.ndarray, np.ndarray]:
    """Distinct positions and their values, the intercept last."""
    at = np.concatenate([*groups, [1 << options.bits]]).astype(np.int64)
    x = np.concatenate([*(np.full(len(g), options.scale / len(g)) for g in groups), [1.0]])
    positions, where = np.unique(at, return_inverse=True)
    return positions, np.bincount(where, x)


def _learned(options: TrainOptions, shard: int, rows: list) -> pa.RecordBatch:
    """The weights that a shard's examples give, in parts."""
    model = Ftrl(options)
    order = np.random.default_rng(1)
    for _ in range(options.passes):
        for i in order.permutation(len(rows)):
            positions, x, label = rows[i]
            model.learn(positions, x.astype(float), label)
    weights = model.weights().astype(np.float32)
    parts = [weights[start : start + _PART].tobytes() for start in range(0, len(weights), _PART)]
    return pa.record_batch({
        "part": pa.array(range(len(parts)), pa.int32()),
        "shard": pa.array([shard] * len(parts), pa.int32()),
        "rows": pa.array([len(rows)] * len(parts), pa.int64()),
        "weights": pa.array(parts, pa.binary()),
    })


def _train(options: TrainOptions, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_learned` of each shard; rows come sorted by shard, and those of one are held."""
    features, rows, last = Features(options.bits), [], None
    for batch in batches:
        columns = batch["shard"].to_pylist(), batch["text"], batch["label"].to_pylist()
        for shard, text, label in zip(*columns, strict=True):
            if rows and shard != last:
                yield _learned(options, last, rows)
                rows = []
            last = shard
            positions, x = _sparse(features(text.as_py()), options)
            rows.append((positions.astype(np.int32), x.astype(np.float32), label))
    if rows:
        yield _learned(options, last, rows)


def _average(learned: pa.Table) -> pa.Table:
    """One part of the weights, averaged over the shards by the rows they saw."""
    learned = learned.sort_by("shard")
    rows, total = learned["rows"].to_pylist(), 0.0
    for weights, seen in zip(learned["weights"], rows, strict=True):
        total = total + (np.frombuffer(weights.as_py(), np.float32) * seen).astype(float)
    average = (total / sum(rows)).astype(np.float32)
    return pa.table({"part": learned["part"].slice(0, 1), "weights": pa.array([average.tobytes()], pa.binary())})


def train(
    docs: DataFrame,
    labels: DataFrame,
    options: TrainOptions = TrainOptions(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> np.ndarray:
    """Weights, the intercept last, learned from labelled documents that are not held out."""
    known = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
        .where(~held_out(id_column))
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.min(label_column).cast("int").alias("label"))
    )
    count = known.count()
    parts = 1 << 30
    if count > options.documents:
        known = known.where(
            F.pmod(F.xxhash64("id"), F.lit(parts)) < F.lit(int(parts * options.documents / count))
        )
    sample = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text")).join(
        F.broadcast(known), "id"  # about options.documents rows of two numbers
    )
    dealt = (
        sample.withColumn("shard", F.pmod(F.hash("id"), F.lit(options.shards)))
        .repartition(_ROOM * options.shards, "shard")
        .sortWithinPartitions("shard", "id", "text")
    )
    learned = dealt.select("shard", "text", "label").mapInArrow(
        partial(_train, options), "part int, shard int, rows long, weights binary"
    )
    weights = np.zeros((1 << options.bits) + 1, np.float32)
    for row in learned.groupBy("part").applyInArrow(_average, "part int, weights binary").collect():
        part = np.frombuffer(row.weights, np.float32)
        weights[row.part * _PART :][: len(part)] = part
    return weights


def _score(weights, options: TrainOptions, kept: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w, features = weights.value, Features(options.bits)
    intercept = float(w[-1])
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            rows, scores = batch.slice(start, _SLICE), []
            for text in rows["text"] if kept is None else pc.struct_field(rows["id"], kept):
                margin = intercept + options.scale * sum(float(w[at].mean()) for at in features(text.as_py() or ""))
                scores.append(1.0 / (1.0 + float(np.exp(-min(max(margin, -35.0), 35.0)))))
            yield pa.record_batch({"id": rows["id"], "score": pa.array(scores, pa.float64())})


def score(
    spark: SparkSession,
    docs: DataFrame,
    weights: np.ndarray,
    options: TrainOptions = TrainOptions(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Id, the columns ``keep`` and ``score``; 1 is high quality. A text that is kept travels once."""
    own = F.struct(F.col(id_column).alias("id"), *keep).alias("id")
    kept = text_column if text_column in keep else None
    rows = docs.select(own, *([] if kept else [F.coalesce(text_column, F.lit("")).alias("text")]))
    shape = StructType([rows.schema["id"], StructField("score", DoubleType())])
    scored = rows.mapInArrow(partial(_score, spark.sparkContext.broadcast(weights), options, kept), shape)
    return scored.select(F.col("id.id").alias(id_column), *[F.col(f"id.`{c}`") for c in keep], "score")
