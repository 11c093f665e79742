"""Shortest-pack-first packing of documents over the histogram of their lengths.

A document's ids (its text's, then an end id) are cut into pieces of the
sequence length and a rest. The histogram of the rests, never longer than the
sequence, is all the driver sees: lengths are placed longest first, always onto
the pack with the most room, and what is kept is one pattern per distinct
content of a pack with the number of packs that share it. Spark then gives
every piece its rank among the pieces of its length; rank and length say which
pattern, which copy of it and which place in it the piece takes.

Ranks need no sort: each scanning task numbers the pieces of a length as it
writes them, and a running sum over (task, length) counts turns these numbers
into ranks, so a length that most documents share is no hot key. The written
pieces hold no ids, only their checksums.

Null texts are empty and give one piece of one id; repeated rows each give their
pieces; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import land, worker_state

class Encoder:
    """Ids of whole texts, as the ``tokenizers`` library gives them for a byte-level BPE file.

    Plain texts (ASCII and Latin letters) go to ``tiktoken`` with the same
    vocabulary, which is several times faster. Others go to ``tokenizers``: there
    the libraries' tables of letters and white space may differ. So does every
    text if the file's merges are not in the order of their ids, since ranks
    would then not say the same.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= letters.keys()}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.fast = None
        if merged == sorted(merged) and len(ranks) == len(model["vocab"]):
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ]").search

    def __call__(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids."""
        if self.fast is None or self.other(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _cut(path: str, size: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = worker_state(f"encoder {path}", lambda: Encoder(path))
    end = np.array([end_id], np.uint32)
    seen: defaultdict[int, int] = defaultdict(int)
    for batch in batches:
        row, start, length, crc, total, nth = [], [], [], [], [], []
        for at, text in enumerate(batch["text"]):
            ids = np.concatenate([encode(text.as_py()), end])
            count = len(ids)
            for first in range(0, count, size):
                piece = ids[first : first + size]
                row.append(at)
                start.append(first)
                length.append(len(piece))
                crc.append(zlib.crc32(piece.astype("<u4").tobytes()))
                total.append(count)
                nth.append(seen[length[-1]])
                seen[length[-1]] += 1
        yield pa.record_batch({
            "id": batch["id"].take(pa.array(row, pa.int32())),
            **{
                name: pa.array(values, pa.int64())
                for name, values in (
                    ("start", start), ("length", length), ("ids_crc32", crc), ("doc_tokens", total), ("nth", nth)
                )
            },
        })


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a pack, number of such packs); every length of the histogram placed as often as it counts."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    most = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            while most > 0 and not room[most]:
                most -= 1
            if most < length:
                room[size - length].append(((length,), left))
                most = max(most, size - length)
                break
            pattern, packs = room[most].pop()
            used = min(left, packs)
            if packs > used:
                room[most].append((pattern, packs - used))
            room[most - length].append(((*pattern, length), used))
            left -= used
    return [entry for entries in room.values() for entry in entries]


class Slots:
    """Where the piece of a length with a rank goes."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]) -> None:
        taken: defaultdict[int, int] = defaultdict(int)
        rows, first = [], 0
        for lengths, packs in patterns:
            offset = 0
            for length in lengths:
                rows.append((length, taken[length], first, offset))
                taken[length] += packs
                offset += length
            first += packs
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4).T
        self.key = table[0] << 48 | table[1]
        self.rank, self.first, self.offset = table[1], table[2], table[3]

    def place(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[name].to_numpy(zero_copy_only=False) for name in ("length", "rank"))
            at = np.searchsorted(self.key, length << 48 | rank, "right") - 1
            columns = {name: batch[name] for name in batch.schema.names if name != "rank"}
            yield pa.record_batch(
                columns | {"sequence_id": self.first[at] + rank - self.rank[at], "offset": self.offset[at]}
            )


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    *,
    size: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = rows.mapInArrow(partial(_cut, path, size, end_id), f"{schema}, nth long")
    pieces = land(spark, pieces.withColumn("task", F.spark_partition_id()), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("pieces"))
    counts = land(spark, counts, "piece-counts")
    lengths = counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()  # at most `size` rows
    slots = Slots(shortest_pack_first({row.length: row.pieces for row in lengths}, size))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(starts, ["task", "length"]).select(
        "id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("nth")).alias("rank")
    )
    placed = ranked.mapInArrow(slots.place, f"{schema}, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_column)
