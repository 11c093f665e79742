"""Approximate nearest neighbours by cross-polytope hashing (Andoni et al., 2015).

A vector's hash is the signed axis nearest to its pseudo-rotation: three rounds
of random signs and a fast Hadamard transform. ``tables`` independent hashes are
kept; a query probes the ``probes`` nearest axes of each. Candidates are ranked
by their exact inner product in double precision.

Largest inner products are not nearest directions when lengths differ, so
vectors get one more coordinate that brings all of them to the largest length
(Bachrach et al., 2014); it is spread over the rotation as a fixed random
direction, and is zero for queries and for vectors of equal length.

Equal vectors are one candidate with their smallest ids, as many as an answer can
need, so a vector that a third of the rows share is searched once. Buckets
are cut into blocks of a bounded number of vectors, queries likewise; a task
multiplies one block of queries with one block of candidates and hands on the
best of each query, so neither a crowded bucket nor a popular query is ever held
by one task, and nothing is dropped. A query's own bucket always has the
query itself, so it finds at least that.

Rows without an id, and vectors that are null, empty, zero, or hold null or
non-finite components, take no part, neither as queries nor as candidates;
vectors of different lengths are not compared. Repeated rows count once; an id
with several vectors is searched by each of them and found by its best. An
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import land


@dataclass(frozen=True)
class Search:
    """Recall grows with tables and probes; the share of rows compared is about tables * probes / (2 d)."""

    neighbours: int = 20
    tables: int = 8
    probes: int = 16
    #: Rows of a block of candidates, and of queries.
    block: int = 512


class CrossPolytope:
    """Hashes of vectors with ``size`` components."""

    def __init__(self, size: int, tables: int) -> None:
        self.size, self.width = size, 1 << max(0, size - 1).bit_length()
        random = np.random.default_rng(size)
        self.signs = random.choice([-1.0, 1.0], (tables, 3, self.width))
        lift = random.standard_normal((tables, self.width))
        self.lift = lift / np.linalg.norm(lift, axis=1, keepdims=True)

    def _hadamard(self, x: np.ndarray) -> np.ndarray:
        step = 1
        while step < self.width:
            x = x.reshape(len(x), -1, 2, step)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), -1)
            step *= 2
        return x / np.sqrt(self.width)

    def rotate(self, x: np.ndarray, table: int, extra: np.ndarray) -> np.ndarray:
        y = np.zeros((len(x), self.width))
        y[:, : self.size] = x
        for signs in self.signs[table]:
            y = self._hadamard(y * signs)
        return y + extra[:, None] * self.lift[table]

    def probes(self, x: np.ndarray, table: int, extra: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` nearest signed axes of each row, nearest first."""
        y = self.rotate(x, table, extra)
        return np.argsort(-np.concatenate([y, -y], 1), axis=1, kind="stable")[:, :count]


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that take part, as bytes of doubles, with their lengths."""
    for batch in batches:
        ids, vectors, norms = [], [], []
        for own, vector in zip(batch["id"], batch["vector"], strict=True):
            if not own.is_valid or not vector.is_valid or vector.values.null_count:
                continue
            x = np.asarray(vector.values, np.float64) + 0.0  # no negative zeros
            norm = float(np.sqrt(np.sum(x * x)))
            if len(x) and np.isfinite(norm) and norm > 0:
                ids.append(own.as_py())
                vectors.append(x.tobytes())
                norms.append(norm)
        yield pa.record_batch({
            "id": pa.array(ids, pa.int64()),
            "vector": pa.array(vectors, pa.binary()),
            "norm": pa.array(norms, pa.float64()),
        })


def _hash(search: Search, longest: float, queries: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per table (and probe): size of the vector, table, axis, id and vector."""
    hashes: dict[int, CrossPolytope] = {}
    for batch in batches:
        vectors = batch["vector"].to_pylist()
        sizes = np.array([len(v) // 8 for v in vectors])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            polytope = hashes.setdefault(int(size), CrossPolytope(int(size), search.tables))
            x = np.frombuffer(b"".join(vectors[i] for i in rows)).reshape(len(rows), size)
            squares = np.sum(x * x, axis=1)
            if queries:
                extra, x, count = np.zeros(len(rows)), x / np.sqrt(squares)[:, None], min(search.probes, 2 * polytope.width)
            else:
                extra = np.sqrt(np.maximum(0.0, 1.0 - squares / longest**2))
                x, count = x / longest, 1
                extra[extra < 1e-6] = 0.0
            taken = batch.select(["id", "vector"]).take(pa.array(np.repeat(rows, count)))
            for table in range(search.tables):
                axes = polytope.probes(x, table, extra, count)
                yield pa.record_batch({
                    "size": pa.array(np.full(len(taken), size, np.int32)),
                    "table": pa.array(np.full(len(taken), table, np.int32)),
                    "axis": pa.array(axes.reshape(-1).astype(np.int32)),
                    "id": taken["id"],
                    "vector": taken["vector"],
                })


def _best(search: Search, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block of queries and block of candidates, the best candidates of each query."""
    most = search.neighbours + 1  # the query itself may be among them
    for batch in batches:
        for row in range(len(batch)):
            size = batch["size"][row].as_py()
            own, found = (np.asarray(batch[name][row].values, np.int64) for name in ("queries", "candidates"))
            x, y = (
                np.frombuffer(b"".join(batch[name][row].values.to_pylist())).reshape(-1, size)
                for name in ("query_vectors", "candidate_vectors")
            )
            scores = x @ y.T
            if len(found) > most:
                limit = -np.partition(-scores, most - 1, axis=1)[:, most - 1]
                at, to = np.nonzero(scores >= limit[:, None] - 1e-9 * np.abs(limit[:, None]))
            else:
                at, to = np.nonzero(np.ones(scores.shape, bool))
            exact = np.sum(x[at] * y[to], axis=1)  # the same sum for the same pair, wherever it is taken
            order = np.lexsort((found[to], -exact, at))
            at, to, exact = at[order], to[order], exact[order]
            keep = np.arange(len(at)) - np.searchsorted(at, at) < most
            yield pa.record_batch({
                "query": pa.array(own[at[keep]]),
                "candidate": pa.array(found[to[keep]]),
                "score": pa.array(exact[keep]),
            })


def _blocks(hashed: DataFrame, search: Search, prefix: str) -> DataFrame:
    """Rows of a bucket gathered into arrays of at most about ``block`` of them.

    A bucket's members are dealt over as many blocks as its count asks for.
    """
    bucket = ["size", "table", "axis"]
    counts = hashed.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / search.block).cast("long").alias("blocks"))
    dealt = hashed.join(F.broadcast(counts), bucket)  # tables x 2 d rows for vectors of d components
    return (
        dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .groupBy(*bucket, "block")
        .agg(F.sort_array(F.collect_list(F.struct("id", "vector"))).alias("rows"))
        .select(*bucket, F.col("rows.id").alias(f"{prefix[0]}"), F.col("rows.vector").alias(f"{prefix[1]}"))
    )


def nearest(
    spark: SparkSession,
    vectors: DataFrame,
    queries: DataFrame,
    search: Search = Search(),
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's nearest other rows.

    ``queries`` is a condition on ``vectors``' columns.
    """
    schema = "id long, vector binary, norm double"
    chosen = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    chosen = land(spark, chosen.mapInArrow(_clean, schema).distinct(), "vectors")
    most = search.neighbours + 1
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    distinct = (
        chosen.withColumn("place", place)
        .where(F.col("place") <= most)
        .groupBy("vector")
        .agg(F.min("id").alias("first"), F.sort_array(F.collect_list("id")).alias("ids"))
    )
    # An id may have several vectors, so a distinct vector is named by a number of its own.
    # It is numbered in the order of its smallest id, which also settles ties.
    distinct = distinct.orderBy("first", "vector").withColumn("at", F.monotonically_increasing_id())
    distinct = land(spark, distinct, "distinct-vectors")
    asked = chosen.join(queries.select(F.col(id_column).cast("long").alias("id")).distinct(), "id", "left_semi")
    asked = land(spark, asked.join(distinct.select("vector", "at"), "vector").select("id", "at"), "queries")
    longest = chosen.agg(F.max("norm")).first()[0] or 1.0

    schema = "size int, table int, axis int, id long, vector binary"
    points = distinct.select(F.col("at").alias("id"), "vector")
    probing = points.join(asked.select(F.col("at").alias("id")).distinct(), "id", "left_semi")
    hashed = points.mapInArrow(partial(_hash, search, longest, False), schema)
    probes = probing.mapInArrow(partial(_hash, search, longest, True), schema)
    pairs = _blocks(probes, search, ("queries", "query_vectors")).join(
        _blocks(hashed, search, ("candidates", "candidate_vectors")), ["size", "table", "axis"]
    )
    found = pairs.select("size", "queries", "query_vectors", "candidates", "candidate_vectors").mapInArrow(
        partial(_best, search), "query long, candidate long, score double"
    )
    found = found.groupBy("query", "candidate").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("candidate"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).drop("rank")
    answers = (
        found.join(distinct.select(F.col("at").alias("candidate"), "ids"), "candidate")
        .join(asked.select(F.col("at").alias("query"), F.col("id").alias("query_id")), "query")
        .select("query_id", F.explode("ids").alias("vec_id"), "score")
        .where("vec_id != query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    return (
        answers.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= search.neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
