"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti and Kaushik, 2006).

A document is the set of its distinct word n-grams, as 64-bit hashes. Sizes are
cut into bands such that similar sets lie in one band or in neighbouring ones.
For a band with largest size r, similar sets differ in at most
k = 2 r (100 - t) / (100 + t) elements. The n-gram domain is hashed into
partitions, and a signature is a hash of what a set has in a subset of them:

* k <= 3: ceil((k+1)/2) partitions, each of ``n2`` parts. One partition differs
  in at most one element, so of the subsets of ``n2 - 1`` of its parts one agrees.
* beyond: k + 1 + s partitions, each its own subset. At least s + 1 of them
  agree, so a partition in which a set has nothing, or one element only, needs no signature
  unless more than s of the set's partitions are so light. The s spare partitions make
  that rare, and unrelated sets do not meet over empty partitions or a single shared
  n-gram. Where light partitions would take too many spare ones, only empty ones go unsigned.

A set signs for its own band and the next one. Signatures are complete: every
similar pair shares one. Sets that share a signature belong together, and the smallest id of
a signature is its centre. All signatures of one centre form one group: near copies share dozens
of signatures with the same centre, and so are dealt once and not dozens of times. Pairs are
tested exactly, on the whole sets, but never all pairs of a group. Pairs are tested only
if their sketches, one byte per hash bucket, do not already differ in more places than
similar sets have differing elements. That bound is exact; it is taken inside a task, over
blocks of bounded size. One round tests each member's closest partner, which joins most of
what belongs together into components, and a second one tests all pairs that are left
between different components, in the groups that still hold several, so a family of many
half-similar texts sends few pairs to the test. Groups without a pair in the first round are
not dealt again. Pairs inside a component need none.

Equal sets are found by a 128-bit hash and stand for one another; each scanning
task signs only the first of those it meets, so a text that a third of all rows
copy sends few signatures. Neither signatures nor sets are stored: texts are scanned once for
sizes, hashes and sketches and once more for signatures, which go straight into their shuffle;
the texts of ids in candidate pairs are read again, and a candidate pair travels with one set at a time.

Null and empty texts have empty sets and are linked with nothing. Rows without
an id are linked with nothing and have no component; an id that occurs with
several texts links by any of them, and each of its rows is returned. An empty
table gives an empty result; further columns are not read. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.scratch import land, release, small_batches

_MEMORY = 200_000  # words whose hashes a task remembers
_FILTER_BITS = 1 << 23  # of the bitmap that keeps unwanted texts out of a shuffle
_BLOCK = 4096  # members of a group that one task compares with as many others
_ROWS = 1 << 16  # signatures of a batch, which bounds what a worker and its executor hold beside the texts
_TEXTS = 1024  # texts, or pairs of sets, that travel to a worker together
_ONE = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _TWO
    x = (x ^ (x >> np.uint64(32))) * _TWO
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Likeness:
    """Words per n-gram, and the least Jaccard similarity in whole percent."""

    words: int = 5
    percent: int = 80


class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word)
        if len(self) < _MEMORY:
            self[word] = code
        return code


class Shingles:
    """Sorted distinct n-gram hashes of texts; A-Z count as lower case, words end at ASCII white space."""

    def __init__(self, words: int) -> None:
        self.words, self.codes = words, Words()

    def __call__(self, text: str) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.empty(0, np.uint64)
        codes = np.fromiter(map(self.codes.__getitem__, found), np.uint64, len(found))
        if len(found) < self.words:
            return np.array([xxhash.xxh64_intdigest(codes.tobytes(), seed=len(found))], np.uint64)
        grams = codes[: len(codes) - self.words + 1].copy()
        for i in range(1, self.words):
            grams = _mix(grams * _ONE) + codes[i : len(codes) - self.words + 1 + i]
        return np.unique(_mix(grams))


class Bands:
    """Size bands and the partitions of each."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.lows, self.highs = [1], [100 // percent]

    def band(self, size: int) -> int:
        while self.highs[-1] < size:
            self.lows.append(self.highs[-1] + 1)
            self.highs.append(100 * self.lows[-1] // self.percent)
        return int(np.searchsorted(self.highs, size))

    def differences(self, band: int) -> int:
        """The most elements that similar sets of this band, or of it and the one below, do not share."""
        while len(self.highs) <= band:
            self.band(self.highs[-1] + 1)
        return 2 * self.highs[band] * (100 - self.percent) // (100 + self.percent)


def _signatures(grams: np.ndarray, bands: Bands, band: int) -> np.ndarray:
    """Signatures of a set in the partitions of a band."""
    k = bands.differences(band)
    if k == 0:  # such sets are similar only when equal
        return np.empty(0, np.uint64)
    least = bands.lows[band - 1] if band else 1
    place = _mix(grams + np.uint64((band + 1) * int(_ONE) & 0xFFFFFFFFFFFFFFFF))
    value = _mix(grams * _ONE + np.uint64(band))
    small = k <= 3
    spare, fewest = _spare(k, least)
    n1, n2 = ((k + 2) // 2, 4 if k == 1 else 3) if small else (k + 1 + spare, 1)
    n = n1 * n2
    part = ((place >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(part)
    part = part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    parts = part[starts]
    sums = np.zeros(n, np.uint64)
    sums[parts.astype(np.int64)] = np.add.reduceat(value[order], starts)
    tag = np.uint64(band) << np.uint64(32)
    if not small:
        heavy = parts[np.diff(np.r_[starts, len(part)]) >= fewest]
        signed = heavy if n - len(heavy) <= n - k - 1 else np.arange(n, dtype=np.uint64)
        return _mix(sums[signed.astype(np.int64)] + _mix((tag | signed) * _ONE))
    signs = []
    for first in range(n1):
        for chosen in combinations(range(n2), n2 - 1):
            mixed = _mix(np.array([tag | np.uint64(first << 10 | sum(1 << c for c in chosen))], np.uint64))
            for c in chosen:
                mixed = _mix(mixed * _ONE) + sums[first * n2 + c]
            signs.append(_mix(mixed))
    return np.concatenate(signs)


def _sketch(grams: np.ndarray, bands: Bands) -> bytes:
    """A byte per bucket, up to six buckets per element that a similar set may lack.

    Sets that differ in d elements differ in at most d buckets. Grams are sorted,
    so their leading bits are the bucket; neighbouring buckets fold into one by
    exclusive or, which makes sketches of different sizes comparable.
    """
    bits = max(4, (3 * bands.differences(bands.band(len(grams)) + 1)).bit_length())
    bucket = (grams >> np.uint64(64 - bits)).astype(np.int64)
    value = ((grams * _TWO) >> np.uint64(56)).astype(np.uint8)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sketch = np.zeros(1 << bits, np.uint8)
    sketch[bucket[starts]] = np.bitwise_xor.reduceat(value, starts)
    return sketch.tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    found = np.frombuffer(sketch, np.uint8)
    return found if len(found) == size else np.bitwise_xor.reduce(found.reshape(size, -1), axis=1)


def _spare(k: int, least: int) -> tuple[int, int]:
    """Spare partitions, and the fewest elements of a partition that signs.

    A set of ``least`` elements has more lighter partitions than spare ones about once in a million.
    """
    for fewest in (2, 1):
        spare = 1
        for _ in range(8):
            n = k + 1 + spare
            light = n * float(np.exp(-least / n)) * (1 + least / n if fewest == 2 else 1)
            spare = int(np.ceil(light + 5 * np.sqrt(light))) + 1
        if spare <= (k + 1) // 3:
            break
    return spare, fewest


_KEYED = "id long, n_shingles long, key binary, sketch binary"


def _keys(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes and hashes of sets, and the sketch of the first of equal ones that have an id."""
    shingles, bands, seen = Shingles(like.words), Bands(like.percent), set()
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for text, own in zip(batch["text"], batch["id"], strict=True):
            grams = shingles(text.as_py())
            key = xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None
            sizes.append(len(grams))
            keys.append(key)
            first = key is not None and key not in seen and own.is_valid
            sketches.append(_sketch(grams, bands) if first else None)
            if first:
                seen.add(key)
        yield pa.record_batch({
            "id": batch["id"],
            "n_shingles": pa.array(sizes, pa.int64()),
            "key": pa.array(keys, pa.binary()),
            "sketch": pa.array(sketches, pa.binary()),
        })


def _signs(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per signature of the first of equal sets; rows without an id are left out by the caller."""
    shingles, bands, seen = Shingles(like.words), Bands(like.percent), set()
    ids, signs, held = [], [], 0

    def out() -> pa.RecordBatch:
        values = np.concatenate(signs).view(np.int64)
        return pa.record_batch({"sign": pa.array(values), "id": pa.array(np.concatenate(ids), pa.int64())})

    for batch in batches:
        for text, own in zip(batch["text"], batch["id"].to_numpy(), strict=True):
            grams = shingles(text.as_py())
            key = xxhash.xxh3_128_digest(grams.tobytes())
            if not len(grams) or key in seen:
                continue
            seen.add(key)
            band = bands.band(len(grams))
            signs += [_signatures(grams, bands, b) for b in (band, band + 1)]
            ids.append(np.full(len(signs[-2]) + len(signs[-1]), own))
            held += len(ids[-1])
            if held >= _ROWS:
                yield out()
                ids, signs, held = [], [], 0
    if held:
        yield out()


def _sets(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(like.words)
    for batch in batches:
        sets = [shingles(text.as_py()).tobytes() for text in batch["text"]]
        yield pa.record_batch({"id": batch["id"], "grams": pa.array(sets, pa.binary())})


def _similar(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch["x"], batch["y"], strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - common
            keep.append(union > 0 and 100 * common >= like.percent * union)
        mask = pa.array(keep, pa.bool_())
        yield pa.record_batch({"a": batch["a"].filter(mask), "b": batch["b"].filter(mask)})


def _most(like: Likeness, x, y):
    """The most elements that similar sets of these sizes do not share."""
    return (x + y) * (100 - like.percent) // (100 + like.percent)


def _plausible(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and sketches allow them to be similar."""
    for batch in batches:
        keep = []
        columns = (batch[c].to_pylist() for c in ("a_n", "b_n", "x", "y"))
        for a_n, b_n, x, y in zip(*columns, strict=True):
            size = min(len(x), len(y))
            near = 100 * min(a_n, b_n) >= like.percent * max(a_n, b_n)
            keep.append(bool(near and np.count_nonzero(_folded(x, size) != _folded(y, size)) <= _most(like, a_n, b_n)))
        mask = pa.array(keep, pa.bool_())
        yield pa.record_batch({"a": batch["a"].filter(mask), "b": batch["b"].filter(mask)})


def _pairs(like: Likeness, closest: bool, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Plausible pairs between components in the groups of ``rows``.

    With ``closest`` a member's closest one only, and the centre of the group that has it.
    """
    group = np.stack([rows[c].to_numpy() for c in ("centre", "low", "high")])
    starts = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0)])
    ids, labels, sizes, blocks = (rows[c].to_numpy() for c in ("id", "label", "n_shingles", "block"))
    sketches = rows["sketch"].to_pylist()
    found_a, found_b, found_in = [], [], []
    for start, stop in zip(starts, [*starts[1:], len(ids)], strict=True):
        size = min(map(len, sketches[start:stop]))
        matrix = np.stack([_folded(x, size) for x in sketches[start:stop]])
        i, n, label = ids[start:stop], sizes[start:stop], labels[start:stop]
        first = np.flatnonzero(blocks[start:stop] == group[1][start])
        second = np.flatnonzero(blocks[start:stop] == group[2][start])
        step = max(1, (1 << 22) // max(1, len(second) * size))
        for part in (first[k : k + step] for k in range(0, len(first), step)):
            differ = (matrix[part][:, None, :] != matrix[second][None, :, :]).sum(axis=2)
            allowed = differ <= _most(like, n[part][:, None], n[second][None, :])
            allowed &= label[part][:, None] != label[second][None, :]
            if not allowed.any():
                continue
            if closest:
                a = np.flatnonzero(allowed.any(axis=1))
                b = np.where(allowed, differ, size + 1)[a].argmin(axis=1)
            else:
                a, b = np.nonzero(allowed)
            found_a.append(i[part[a]])
            found_b.append(i[second[b]])
            found_in.append(np.full(len(a), group[0][start]))
    if found_a:
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        found = [np.minimum(a, b), np.maximum(a, b)] + [np.concatenate(found_in)] * closest
        found = np.unique(np.stack(found), axis=1)  # groups repeat pairs
        yield pa.record_batch(dict(zip(("a", "b", "centre"), found, strict=False)))


def _across(like: Likeness, closest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_pairs` of rows that come sorted by group; beyond a batch, only rows of one group are held."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.stack([batch[c].to_numpy() for c in ("centre", "low", "high")])
        if rest and [rest[-1][c][-1].as_py() for c in ("centre", "low", "high")] != group[:, 0].tolist():
            yield from _pairs(like, closest, pa.Table.from_batches(rest))
            rest = []
        # The last group of a batch may go on in the next one.
        other = np.flatnonzero((group != group[:, -1:]).any(axis=0))
        if len(other):
            last = int(other[-1]) + 1
            yield from _pairs(like, closest, pa.Table.from_batches([*rest, batch.slice(0, last)]))
            rest = [batch.slice(last)]
        else:
            rest.append(batch)
    if rest:
        yield from _pairs(like, closest, pa.Table.from_batches(rest))


def _hash_bit() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(_FILTER_BITS))


def _wanted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the given ids, and some of other ids.

    Before any wide row is shuffled for a join, most others are dropped by a bitmap
    of hashed ids: 256 rows of 4 KB, whatever the number of ids.
    """
    bitmap = ids.select(_hash_bit().alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    position = F.bitmap_bit_position(_hash_bit())
    byte = F.conv(F.hex(F.substring("bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return (
        rows.withColumn("bucket", F.bitmap_bucket_number(_hash_bit()))
        .join(F.broadcast(bitmap), "bucket")
        .where(F.getbit(byte, (position % 8).cast("int")) == 1)
        .select(*rows.columns)
    )


def _test(spark: SparkSession, texts: DataFrame, pairs: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _wanted(texts, wanted).join(wanted, "id", "left_semi").mapInArrow(partial(_sets, like), "id long, grams binary")
    with small_batches(spark, _TEXTS):
        sets = land(spark, sets, "partenum-sets")
    sided = pairs.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a"
    )
    links = sided.select("a", "b", "x", "y").mapInArrow(partial(_similar, like), "a long, b long").distinct()
    with small_batches(spark, _TEXTS):
        links = land(spark, links, "partenum-links")
    release(spark, sets)
    return links


def jaccard_components(
    spark: SparkSession,
    docs: DataFrame,
    like: Likeness = Likeness(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id it is linked to, directly or not)."""
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    with small_batches(spark, _TEXTS):
        keyed = land(spark, texts.mapInArrow(partial(_keys, like), _KEYED), "partenum-keys")
    named = keyed.where("id is not null and key is not null")
    copies = named.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    first = land(spark, named.select("id", "key").join(copies, "key").select("id", "first").distinct(), "partenum-copies")
    links = first.select(F.col("id").alias("a"), F.col("first").alias("b")).where("a != b")

    # Who shares a signature with its smallest id, each set as its first copy. The window runs
    # through the rows of a signature and holds one of them.
    so_far = Window.partitionBy("sign").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = (
        texts.where("id is not null")
        .mapInArrow(partial(_signs, like), "sign long, id long")
        .withColumn("centre", F.first("id").over(so_far))
        .where("centre != id")
        .select("centre", "id")
        .distinct()
    )
    of_centre = first.select(F.col("id").alias("centre"), F.col("first").alias("first_centre"))
    met = met.join(first, "id", "left").join(of_centre, "centre", "left").select(
        F.coalesce("first_centre", "centre").alias("centre"), F.coalesce("first", "id").alias("id")
    )
    met = met.where("centre != id")
    met = met.union(met.select("centre", F.col("centre").alias("id")))
    with small_batches(spark, _TEXTS):
        members = land(spark, met.distinct(), "partenum-members")

    # The sketches of the members, also from rows that a member stands for. Only these rows are shuffled.
    single = members.select("id").distinct()
    stands = first.join(single.withColumnRenamed("id", "first"), "first", "left_semi").select("id", "first")
    stands = land(spark, stands.union(single.select("id", F.col("id").alias("first"))).distinct(), "partenum-stands")
    sketches = _wanted(named.where("sketch is not null").select("id", "n_shingles", "sketch"), stands).join(stands, "id")
    sketches = sketches.select(F.col("first").alias("id"), "n_shingles", "sketch").distinct()
    sketches = land(spark, sketches, "partenum-sketches")
    release(spark, stands)
    rows = land(spark, keyed.select("id", "n_shingles", F.col("key").isNull().alias("empty")), "partenum-rows")
    release(spark, keyed)

    # Members of different components, in the groups that have several. Equal sets are one member.
    # A group in which the first round saw no plausible pair has none in the second one either.
    live, tested = None, spark.createDataFrame([], "a long, b long")
    labels = land(spark, components(spark, links), "partenum-labels")
    for closest in (True, False):
        labelled = members.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id"))
        labelled = land(spark, labelled.drop("component"), "partenum-labelled")
        mixed = labelled.groupBy("centre").agg(
            F.min("label").alias("least"), F.max("label").alias("most"), F.count(F.lit(1)).alias("size")
        ).where("least != most")
        if live is not None:
            mixed = mixed.join(live.select("centre").distinct(), "centre", "left_semi")
        blocks = F.ceil(F.col("size") / _BLOCK).cast("int").alias("blocks")
        dealt = land(spark, labelled.join(mixed.select("centre", blocks), "centre"), "partenum-mixed")
        release(spark, labelled, members, *([live] if live is not None else []))
        members = dealt.select("centre", "id")
        block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        ordered = (
            dealt.withColumn("block", block)
            .withColumn("other", other)
            .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
            .join(sketches, "id")
            .select("centre", "low", "high", "block", "id", "label", "n_shingles", "sketch")
            .repartition("centre", "low", "high")
            .sortWithinPartitions("centre", "low", "high")
        )
        schema = "a long, b long, centre long" if closest else "a long, b long"
        met = land(spark, ordered.mapInArrow(partial(_across, like, closest), schema).distinct(), "partenum-met")
        across = met.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
        across, live = land(spark, across, "partenum-pairs"), met
        members = land(spark, members, "partenum-members")
        release(spark, dealt)
        if not across.isEmpty():
            tested = tested.union(across)
            links = links.union(_test(spark, texts, across, like))
            before, labels = labels, land(spark, components(spark, links), "partenum-labels")
            release(spark, before)
    release(spark, members, live, sketches)
    component = F.when(F.col("empty"), F.col("id")).otherwise(F.coalesce("component", "id"))
    return rows.join(labels, "id", "left").select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"))


def keep_one(
    spark: SparkSession,
    docs: DataFrame,
    like: Likeness = Likeness(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of its component.

    Rows without an id stay. An id that occurs more than once is one document:
    of its rows the one with the smallest text stays.
    """
    names, place = [F.col(f"`{name}`") for name in docs.columns], "place"
    while place in docs.columns:
        place += "_"
    found = jaccard_components(spark, docs, like, id_column=id_column, text_column=text_column)
    drop = found.where(F.col("component_id") != F.col(id_column)).select(id_column).distinct()
    rest = docs.join(drop, id_column, "left_anti").select(*names)
    again = docs.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.count(F.lit(1)).alias("rows"))
    again = land(spark, again.where("rows > 1").select(id_column), "repeated-ids")
    if again.isEmpty():
        return rest
    same = rest.join(again, id_column, "left_semi").select(*names)
    order = Window.partitionBy(id_column).orderBy(text_column)
    one = same.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*names)
    return rest.join(again, id_column, "left_anti").select(*names).union(one)
