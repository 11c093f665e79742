"""Ranked lexical search: term-at-a-time with limited accumulators.

Terms are the runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased. Documents are read once into a table of their query terms and counts, from
which Spark counts the documents of each term. Every task then ranks a chunk of that
table for each item on its own: the item's terms come rarest first, each adding its weight
times a saturated count to the accumulators of the documents that hold it. Before a term,
the largest contributions of the terms still to come are summed (largest in this chunk);
once that sum is below the k-th best partial score, no document without an accumulator
can reach the first k, so none is created any more, and the remaining terms only update
the documents that have one, exactly. The first k of every chunk meet in two rounds of
ranking, so no task ever sees more than k rows of an item from each chunk or salt.

Items are a stated query set and are taken in blocks of at most ``SearchOptions.pairs``
(item, term) pairs; a block's vocabulary and terms are all that is broadcast or passes
through the driver. A single larger item is a block of its own. Every block reads the
documents again. Scores are integers, so nothing depends on the order of additions.

Defined cases: a null text has no term; a document without a term counts neither as one of
N nor in L and is never found. Repeated rows and equal ids are documents of their own;
equal scores go by ascending id, null ids last. Rows of one item id, null included, are one
item with all their terms; an item without a term, or whose terms nothing holds, has no
rows. An empty table on either side gives an empty result. Texts are read whole. Columns
other than the ids and the texts are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.scratch import land

_LAST = np.iinfo(np.int64).max  # stands for a null id inside a task


@dataclass(frozen=True)
class SearchOptions:
    k: int = 50
    pairs: int = 200_000  # (item, term) pairs of a block
    postings: int = 4_000_000  # of a chunk that one task ranks at a time
    salts: int = 64


def _separators() -> bytes:
    """For ``bytes.translate``: ASCII marks become spaces, A-Z lower case, all else stays."""
    return bytes(
        c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower()
    )


def _tokens(texts, table: bytes) -> Iterator[list[bytes]]:
    """The terms of each text as UTF-8; no byte of a character beyond ASCII is an ASCII one."""
    for text in texts:
        yield (text.as_py() or "").encode("utf-8", "surrogatepass").translate(table).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _separators()
    for batch in batches:
        found = [sorted(set(words)) for words in _tokens(batch["text"], table)]
        yield pa.record_batch({"item": batch["item"], "terms": pa.array(found, pa.list_(pa.binary()))})


def _count_terms(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document with a term: how many it has, and its query terms with their counts."""
    table, number = _separators(), shared.value.get
    for batch in batches:
        lengths, terms, counts = [], [], []
        for words in _tokens(batch["text"], table):
            lengths.append(len(words))
            known = [n for n in map(number, words) if n is not None]
            at, tf = np.unique(np.asarray(known, np.int32), return_counts=True)
            terms.append(at)
            counts.append(tf.astype(np.int32))
        found = pa.record_batch({
            "id": batch["id"],
            "n": pa.array(lengths, pa.int64()),
            "terms": pa.array(terms, pa.list_(pa.int32())),
            "counts": pa.array(counts, pa.list_(pa.int32())),
        })
        yield found.filter(pa.array([n > 0 for n in lengths]))


@dataclass(frozen=True)
class Weighted:
    """Items of a block: their numbered terms, rarest first, and what scores need of the corpus."""

    items: list[tuple[int, np.ndarray]]
    weights: np.ndarray
    documents: int
    all_terms: int


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: highest score first, then the smaller id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def accumulate(terms: list[tuple[np.ndarray, np.ndarray]], size: int, k: int) -> tuple[np.ndarray, int]:
    """Scores of ``size`` documents, 0 where no accumulator was kept, and the number of accumulators.

    ``terms`` holds (places, contributions) rarest first. Whoever could be among the
    first ``k`` has its exact score.
    """
    scores, has = np.zeros(size, np.int64), np.zeros(size, bool)
    bounds = [int(gains.max(initial=0)) for _, gains in terms]
    left, open_, made = sum(bounds), True, 0
    for (places, gains), bound in zip(terms, bounds, strict=True):
        if open_ and made >= k:
            open_ = left >= int(np.partition(scores[has], -k)[-k])
        if open_:
            has[places] = True
            made = int(np.count_nonzero(has))
        else:
            alive = has[places]
            places, gains = places[alive], gains[alive]
        scores[places] += gains
        left -= bound
    return scores, made


def _rank_chunk(ids, n, sizes, terms, counts, query: Weighted, k: int) -> Iterator[pa.RecordBatch]:
    m = 50 + (50 * n * query.documents) // query.all_terms
    doc = np.repeat(np.arange(len(ids), dtype=np.int64), sizes)
    tf = counts.astype(np.int64)
    order = np.argsort(terms, kind="stable")
    doc, tf, terms = doc[order], tf[order], terms[order]
    gains = query.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
    ends = np.searchsorted(terms, np.arange(len(query.weights) + 1))
    for number, wanted in query.items:
        lists = [(doc[ends[t] : ends[t + 1]], gains[ends[t] : ends[t + 1]]) for t in wanted]
        scores, _ = accumulate(lists, len(ids), k)
        found = np.flatnonzero(scores > 0)
        best = found[first_of(scores[found], ids[found], k)]
        if len(best):
            yield pa.record_batch({
                "item": pa.array(np.full(len(best), number, np.int64)),
                "doc": pa.array(ids[best], mask=ids[best] == _LAST),
                "score": pa.array(scores[best]),
            })


def _rank(shared, options: SearchOptions, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    query, held, postings = shared.value, [], 0

    def ranked():
        columns = [np.concatenate(parts) for parts in zip(*held, strict=True)]
        yield from _rank_chunk(*columns, query, options.k)

    for batch in batches:
        terms, counts = batch["terms"], batch["counts"]
        sizes = np.asarray(terms.value_lengths())
        held.append((
            batch["id"].fill_null(_LAST).to_numpy(zero_copy_only=False),
            batch["n"].to_numpy(zero_copy_only=False),
            sizes,
            terms.flatten().to_numpy(zero_copy_only=False),
            counts.flatten().to_numpy(zero_copy_only=False),
        ))
        postings += int(sizes.sum()) + len(sizes)
        if postings >= options.postings:
            yield from ranked()
            held, postings = [], 0
    if held:
        yield from ranked()


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(rows: Iterator[T.Row], limit: int) -> Iterator[list[T.Row]]:
    block, pairs = [], 0
    for row in rows:
        if block and pairs + len(row.terms) > limit:
            yield block
            block, pairs = [], 0
        block.append(row)
        pairs += len(row.terms)
    if block:
        yield block


def _search_block(spark: SparkSession, docs: DataFrame, block: list[T.Row], options: SearchOptions) -> DataFrame:
    vocabulary = {term: i for i, term in enumerate(sorted({bytes(t) for row in block for t in row.terms}))}
    schema = "id long, n long, terms array<int>, counts array<int>"
    index = docs.mapInArrow(partial(_count_terms, spark.sparkContext.broadcast(vocabulary)), schema)
    index = land(spark, index, "terms")
    documents, all_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term
        df[term] = count
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(held) + 1))) for held in df]
    items = []
    for row in block:
        wanted = [vocabulary[bytes(t)] for t in row.terms]
        items.append((row.number, np.asarray(sorted(wanted, key=lambda t: (df[t], t)), np.int64)))
    query = Weighted(items, np.asarray(weights, np.int64), documents, all_terms)
    run = partial(_rank, spark.sparkContext.broadcast(query), options)
    return index.mapInArrow(run, "item long, doc long, score long")


def search(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    options: SearchOptions = SearchOptions(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``item_column``, ``rank``, ``doc_id``, ``score``: the best documents of each item; document ids are integers."""
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    asked = items.select(F.struct(F.col(item_column).alias("item")).alias("item"), F.col(item_text_column).alias("text"))
    schema = T.StructType([asked.schema["item"], T.StructField("terms", T.ArrayType(T.BinaryType()))])
    asked = asked.mapInArrow(_item_terms, schema).select("item", F.explode("terms").alias("term")).distinct()
    asked = asked.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    asked = land(spark, asked.withColumn("number", F.monotonically_increasing_id()), "items")
    empty = spark.createDataFrame([], "item long, doc long, score long")
    found = [
        land(spark, _search_block(spark, texts, block, options), "found")
        for block in _blocks(asked.select("number", "terms").toLocalIterator(), options.pairs)
    ]
    rows = reduce(DataFrame.union, found, empty)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(options.salts)))
    best = _best(_best(salted, ["item", "salt"], options.k), ["item"], options.k)
    names = asked.select(F.col("number").alias("item"), F.col("item.item").alias("name"))
    return best.join(names, "item").select(
        F.col("name").alias(item_column.strip("`")), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score"
    )
