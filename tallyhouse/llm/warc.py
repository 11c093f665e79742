"""WARC archives: writing, and reading by verified chains of record boundaries.

Writing: each page is a record; of pages with equal payloads of a least size the
one with the largest id is a ``response``, the others are ``revisit`` records
that refer to it. Pages are matched by a digest table with one row per repeated
payload; texts are written once, by the task that holds them, through Spark's
own text writer, whose line separator is the end of a record.

Reading: archives are split at the magic ``WARC/1.1`` wherever Spark splits the
files. Each piece is a candidate: its offset, and, when its header reads like
one, the offset at which it says the next record starts. Magic inside a payload
makes false candidates. Only what the chain from the start of the file reaches
is a record: pointer jumping doubles every candidate's reach each round, so a
file of n candidates takes log2(n) joins instead of a walk. A record cut by
false candidates is joined from its pieces. Payloads are hashed where they are
read and do not travel, except for such cut records.

Null html is an empty payload; null urls have no target line, control characters
in urls are percent-encoded; rows without an id are written without one and never
referred to; of repeated rows with the largest id all are responses. An empty
table makes an archive without records. Further columns are not written.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import land
from tallyhouse.session import scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = "id long, kind string, refers long, payload_bytes long, payload_digest string"


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">\r\n"))


def archive_records(pages: DataFrame, *, least: int = 1000, date: str = "2025-01-01T00:00:00Z") -> DataFrame:
    """One text ``value`` per page (``page_id``, ``url``, ``html``), a record without its end."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("content"),
    )
    repeated = (
        rows.where(F.col("size") >= least)
        .groupBy("content")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1 and newest is not null")
        .select("content", "newest")
    )
    # Written, so the planner knows its size: if few payloads are repeated, no page is shuffled to find them.
    repeated = land(pages.sparkSession, repeated, "repeated-payloads")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    size = F.col("size").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END)
    )
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    return rows.join(repeated, "content", "left").select(
        F.concat(
            F.lit(MAGIC),
            F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
            F.lit("WARC-Record-ID: "), _urn(F.col("page_id")),
            F.lit(f"WARC-Date: {date}\r\n"),
            F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
            F.lit("WARC-Payload-Digest: sha1:"), F.sha1("payload"), F.lit("\r\n"),
            F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("newest")), F.lit(f"WARC-Profile: {_PROFILE}\r\n"))).otherwise(""),
            F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
            F.octet_length(block).cast("string"), F.lit(END), block,
        ).alias("value")
    )


def write_archives(records: DataFrame, path: str) -> None:
    """One uncompressed archive per task."""
    records.write.option("lineSep", END).option("compression", "none").text(path)


_LENGTH = re.compile(rb"(?:^|\r\n)Content-Length: *([0-9]{1,18})(?:\r\n|$)", re.IGNORECASE)
_HEADERS = {
    name: re.compile(rb"(?:^|\r\n)" + name + rb": *" + value + rb" *(?:\r\n|$)", re.IGNORECASE)
    for name, value in (
        (b"WARC-Type", rb"([a-z]+)"),
        (b"WARC-Record-ID", rb"<urn:page:(-?[0-9]+)>"),
        (b"WARC-Refers-To", rb"<urn:page:(-?[0-9]+)>"),
        (b"WARC-Payload-Digest", rb"sha1:([0-9a-f]{40})"),
    )
}


def _header(piece: bytes) -> tuple[int, int] | None:
    """(length of the header with its blank line, length of the block) of what follows the magic."""
    end = piece.find(b"\r\n\r\n")
    found = _LENGTH.search(piece, 0, end + 2) if end >= 0 else None
    return (end + 4, int(found[1])) if found else None


def _record(piece: bytes) -> tuple:
    """id, kind, refers, payload size and digest of a whole record, without the magic."""
    head, length = _header(piece)
    own = {name: m[1].decode() if (m := rule.search(piece, 0, head)) else None for name, rule in _HEADERS.items()}
    block = memoryview(piece)[head : head + length]
    split = piece.find(b"\r\n\r\n", head, head + length)
    http = bytes(block[: split + 2 - head]) if split >= 0 else b""
    payload = block[split + 4 - head :] if split >= 0 else block
    number = lambda text: None if text is None else int(text)
    if own[b"WARC-Type"] == "revisit":  # the payload is elsewhere; its size and digest are told
        size = int(m[1]) if (m := _LENGTH.search(http)) else None
        digest = own[b"WARC-Payload-Digest"]
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return number(own[b"WARC-Record-ID"]), own[b"WARC-Type"], number(own[b"WARC-Refers-To"]), size, digest


_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
_NAMES = ("id", "kind", "refers", "payload_bytes", "payload_digest")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces between magics: place within the split, length, header extent, and the record if it is whole."""
    split, at = None, 0
    for batch in batches:
        places, lengths, extents, records = [], [], [], []
        for file, block, piece in zip(
            batch["file"].to_pylist(), batch["block"].to_pylist(), batch["piece"], strict=True
        ):
            if (file, block) != split:
                split, at = (file, block), 0
            piece = piece.as_py()
            header = _header(piece)
            extent = sum(header) + len(END) if header else None
            places.append(at)
            lengths.append(len(piece))
            extents.append(extent)
            records.append(_record(piece) if extent == len(piece) else (None,) * 5)
            at += len(piece) + len(MAGIC)
        yield pa.record_batch({
            "file": batch["file"],
            "block": batch["block"],
            "place": pa.array(places, pa.int64()),
            "length": pa.array(lengths, pa.int64()),
            "extent": pa.array(extents, pa.int64()),
            **{
                name: pa.array([r[i] for r in records], kind)
                for i, (name, kind) in enumerate(zip(_NAMES, _TYPES, strict=True))
            },
        })


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )


def _placed(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, at = None, 0
    for batch in pieces:
        places = []
        for file, block, piece in zip(
            batch["file"].to_pylist(), batch["block"].to_pylist(), batch["piece"], strict=True
        ):
            if (file, block) != split:
                split, at = (file, block), 0
            places.append(at)
            at += len(piece.as_buffer()) + len(MAGIC)
        yield pa.record_batch(
            {"file": batch["file"], "block": batch["block"], "place": pa.array(places, pa.int64()), "piece": batch["piece"]}
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        records = []
        for pieces in batch["pieces"]:
            ordered = sorted((p["start"].as_py(), p["piece"].as_py()) for p in pieces.values)
            records.append(_record(MAGIC.encode().join(piece for _, piece in ordered)))
        yield pa.record_batch({
            name: pa.array([r[i] for r in records], kind)
            for i, (name, kind) in enumerate(zip(_NAMES, _TYPES, strict=True))
        })


def chain(spark: SparkSession, candidates: DataFrame) -> DataFrame:
    """The candidates (``file``, ``start``, ``next``) that the chain from the start of each file reaches."""
    nodes = candidates.select(
        "file", "start", F.col("next").alias("jump"), (F.col("start") == len(MAGIC)).alias("reached")
    )
    nodes = land(spark, nodes, "warc-chain")
    most = nodes.groupBy("file").agg(F.count(F.lit(1)).alias("nodes")).agg(F.max("nodes")).first()[0] or 0
    for _ in range(most.bit_length()):
        there = nodes.select("file", F.col("start").alias("jump"), F.col("jump").alias("further"))
        hit = nodes.where("reached").select("file", F.col("jump").alias("start"), F.lit(True).alias("hit")).distinct()
        nodes = land(
            spark,
            nodes.join(there, ["file", "jump"], "left")
            .join(hit, ["file", "start"], "left")
            .select("file", "start", F.col("further").alias("jump"), F.coalesce("hit", "reached").alias("reached")),
            "warc-chain",
        )
    return nodes.where("reached").select("file", "start")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: id, kind, refers, payload_bytes, payload_digest (of the full payload)."""
    schema = f"file string, block long, place long, length long, extent long, {_FIELDS}"
    found = land(spark, _pieces(spark, path).mapInArrow(_candidates, schema), "warc-candidates")
    # Splits of a file lie end to end: what they hold before a split is where it starts.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        found.groupBy("file", "block")
        .agg(F.sum(F.col("length") + len(MAGIC)).alias("bytes"))
        .select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    )
    start = F.col("base") + F.col("place")
    found = found.join(splits, ["file", "block"]).withColumns({
        "start": start,
        "file": F.xxhash64("file"),
        "next": start + F.col("extent") + len(MAGIC),
        "path": F.col("file"),
    })
    found = land(spark, found, "warc-found")
    reached = chain(spark, found.where("next is not null"))
    records = found.join(reached, ["file", "start"])
    whole = records.where(F.col("extent") == F.col("length")).select(*_NAMES)
    cut = land(spark, records.where(F.col("extent") != F.col("length")).select("file", "start", "next"), "warc-cut")
    if cut.isEmpty():
        return whole
    # Pieces of cut records, by the last reached start at or before them.
    own = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        found.join(reached.withColumn("own", F.col("start")), ["file", "start"], "left")
        .withColumn("own", F.last("own", ignorenulls=True).over(own))
        .join(cut.select("file", F.col("start").alias("own"), F.col("next").alias("stop")), ["file", "own"])
        .where("start < stop")
        .select(F.col("path").alias("file"), "block", "place", "start", "own")
    )
    pieces = _pieces(spark, path).mapInArrow(_placed, "file string, block long, place long, piece binary")
    joined = (
        pieces.join(owned, ["file", "block", "place"])
        .groupBy("file", "own")
        .agg(F.collect_list(F.struct("start", "piece")).alias("pieces"))
        .select("pieces")
        .mapInArrow(_joined, _FIELDS)
    )
    return whole.union(joined)


def round_trip(spark: SparkSession, pages: DataFrame, *, least: int = 1000) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = scratch_path(spark, "warc")
    write_archives(archive_records(pages, least=least), path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return read_archives(spark, path)
