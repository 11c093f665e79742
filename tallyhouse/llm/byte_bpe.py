"""Byte-level BPE encoding and decoding with a bitmap queue of merge ranks.

A pre-token is a doubly linked list of symbols. Every adjacent pair that has a
merge rank waits in the bucket of that rank, as list positions. A two-level
bitmap marks the ranks whose bucket is not empty: find-first-set on the upper
word, then on the lower one, gives the next rank in constant time. Entries are
never searched for or removed when a neighbour changes; one whose pair has
changed in the meantime is stale and skipped when its bucket comes up. A
pre-token of n bytes takes O(n log n) time, the logarithm being the heaps of
single buckets, so a text without spaces costs little more than prose.

Every text is encoded whole. Null texts are empty, empty texts have no ids;
repeated rows each give a row, an empty table none, and further columns of the
input (whatever their names) are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import worker_state

# Code points that the installed `regex` counts as letters or numbers and
# the Unicode edition behind the rank files' reference library does not assign yet.
_UNASSIGNED = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d "
    "107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 "
    "1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff "
    "18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 "
    "1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 "
    "1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 "
    "3d000-3fc3f"
)
_LATER = "".join(
    "-".join(f"\\U{int(point, 16):08x}" for point in span.split("-")) for span in _UNASSIGNED.split()
)
#: Distinct pre-tokens remembered by a Python worker, and the longest remembered one.
CACHE_ENTRIES = 1_000_000
CACHE_LENGTH = 64


class ByteBpe:
    """A vocabulary of byte strings with ranks; lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        wide = pattern.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{_LATER}])+")
        for letters in (r"\p{L}", r"\p{N}"):
            wide = wide.replace(f" ?{letters}+", f" ?(?:(?![{_LATER}]){letters})+")
        wide = regex.compile(wide).findall
        # Below U+0250 the classes can be said in the faster `re`, but for its further white space.
        letters, numbers = r"[^\W\d_²³¹¼½¾]", r"[\d²³¹¼½¾]"
        low = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", letters).replace(r"\p{N}", numbers)
        low = re.compile(low).findall
        other = re.compile(r"[^\x00-\x1b\x20-\u024f]").search
        self.split = lambda text: wide(text) if other(text) else low(text)
        self._cache: dict[str, bytes] = {}

    @classmethod
    def read(cls, path: str, pattern: str) -> ByteBpe:
        """From a file of lines ``base64 rank``."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        return cls(ranks, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        size = len(piece)
        find = ranks.get
        following = list(range(1, size + 1))
        previous = list(range(-1, size - 1))
        # Of the pair that starts at i: its rank and its end; -1 where none merges.
        rank_at = [find(piece[i : i + 2], -1) for i in range(size)]
        rank_at[size - 1] = -1
        buckets: dict[int, list[int]] = {}
        upper = 0
        lower: dict[int, int] = {}
        for i, rank in enumerate(rank_at):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # ascending, so a heap already
                else:
                    buckets[rank] = [i]
                    group = rank >> 8
                    if group in lower:
                        lower[group] |= 1 << (rank & 255)
                    else:
                        lower[group] = 1 << (rank & 255)
                        upper |= 1 << group
        while upper:
            high = (upper & -upper).bit_length() - 1
            word = lower[high]
            rank = high << 8 | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            lowest = rank
            while bucket and lowest >= rank:
                i = heappop(bucket)
                if rank_at[i] != rank:
                    continue  # stale
                absorbed = following[i]
                rank_at[absorbed] = -1
                after = following[i] = following[absorbed]
                if after < size:
                    previous[after] = i
                    new = find(piece[i : following[after]], -1)
                else:
                    new = -1
                at = i
                while True:  # the pair that starts at i, then the one that ends with it
                    if rank_at[at] != new:
                        rank_at[at] = new
                        if new >= 0:
                            if new < lowest:
                                lowest = new
                            if new in buckets:
                                heappush(buckets[new], at)
                            else:
                                buckets[new] = [at]
                                group = new >> 8
                                if group in lower:
                                    lower[group] |= 1 << (new & 255)
                                else:
                                    lower[group] = 1 << (new & 255)
                                    upper |= 1 << group
                    if at != i or previous[i] < 0:
                        break
                    at = previous[i]
                    new = find(piece[at:after], -1)
            if not bucket:
                del buckets[rank]
                word = lower[high] & ~(1 << (rank & 255))
                if word:
                    lower[high] = word
                else:
                    del lower[high]
                    upper &= ~(1 << high)
        ids, i = [], 0
        while i < size:
            ids.append(ranks[piece[i : following[i]]])
            i = following[i]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers, no special tokens."""
        cache, pieces = self._cache, self.split(text)
        try:
            return b"".join(map(cache.__getitem__, pieces))
        except KeyError:
            pass
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        own = {}
        for piece in pieces:
            if piece not in cache and piece not in own:
                known = cache if len(piece) <= CACHE_LENGTH else own
                known[piece] = struct.pack(f"<{len(ids := self.merge(piece.encode('utf-8', 'surrogatepass')))}I", *ids)
        return b"".join(cache[piece] if piece in cache else own[piece] for piece in pieces)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


def encode_documents(
    docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: its id, ``ids`` (unsigned 32-bit, little-endian) and ``n_tokens``."""
    return _map(docs, partial(_encoded, path, pattern), "ids binary, n_tokens long", id_column, text_column)


def round_trip(
    docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode, decode, and hand out digests: ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _map(docs, partial(_digested, path, pattern), schema, id_column, text_column)


def _map(docs: DataFrame, encode: Callable, schema: str, id_column: str, text_column: str) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return rows.mapInArrow(encode, f"id {kind}, {schema}").withColumnRenamed("id", id_column)


def _vocabulary(path: str, pattern: str) -> ByteBpe:
    return worker_state(f"bpe {path} {pattern}", lambda: ByteBpe.read(path, pattern))


def _encoded(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe = _vocabulary(path, pattern)
    for batch in batches:
        ids = [bpe.encode(text.as_py()) for text in batch["text"]]
        yield pa.record_batch({
            "id": batch["id"],
            "ids": pa.array(ids, pa.binary()),
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
        })


def _digested(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe = _vocabulary(path, pattern)
    sha256 = hashlib.sha256
    for batch in batches:
        counts, coded, decoded = [], [], []
        for text in batch["text"]:
            ids = bpe.encode(text.as_py())
            counts.append(len(ids) // 4)
            coded.append(sha256(ids).hexdigest())
            decoded.append(sha256(bpe.decode(ids)).hexdigest())
        yield pa.record_batch({
            "id": batch["id"],
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(coded, pa.string()),
            "decoded_sha256": pa.array(decoded, pa.string()),
        })
