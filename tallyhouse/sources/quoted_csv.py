"""CSV files with line breaks inside quotes, read in blocks by many tasks.

Whether a line starts inside quotes depends on everything before it in its file. Files
are read twice as plain lines. The first scan, the census, asks of every block where a
record would stand at its end if the block began outside quotes, and if it began inside:
a function of one bit. Run through a file's blocks in order these functions tell where
each block really begins. The census also brings the first record of each file, so every
file is read by its own header. The second scan joins the lines of each record and writes
the records; those that cross a block border are written in pieces and put together by a
shuffle of the pieces alone. Fields are split afterwards, by Spark's own CSV parser.

What reaches the driver and every task is one row per block of the input (and its header
per file). Both scans have to see the same blocks; a task that meets an unknown one
fails instead of guessing.
"""

from __future__ import annotations

import csv
import sys
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Options this reader understands; anything else is left to Spark's own reader.
OPTIONS = {"header", "sep", "delimiter", "quote", "escape", "multiLine", "nullValue", "emptyValue"}

_CENSUS = (
    "path string, key long, start long, from_outside boolean, from_inside boolean, closes boolean, header string, text boolean"
)
_CENSUS_ARROW = pa.schema([
    ("path", pa.string()), ("key", pa.int64()), ("start", pa.int64()), ("from_outside", pa.bool_()),
    ("from_inside", pa.bool_()), ("closes", pa.bool_()), ("header", pa.string()), ("text", pa.bool_()),
])
_RECORDS = "layout int, sheet string, record string, owner long, start long, key long"
_BAD = "malformed"
_EMPTY = ("", "\r")


@dataclass(frozen=True)
class Quotes:
    """Where quotes begin and end. A field is quoted if it begins with a quote; what follows its closing quote is plain."""

    sep: str = ","
    quote: str = '"'
    escape: str = '"'

    def _closed(self, line: str, at: int) -> int:
        """Place after the closing quote of a field that is open at ``at``, or -1."""
        while True:
            end = line.find(self.quote, at)
            if end < 0:
                return -1
            if self.escape == self.quote:
                if not line.startswith(self.quote, end + 1):
                    return end + 1
                at = end + 2
            else:
                escaped = end - len(line[at:end].rstrip(self.escape)) - at
                if escaped % 2 == 0:
                    return end + 1
                at = end + 1

    def after(self, line: str, inside: bool) -> bool:
        """Whether the end of a line is inside quotes."""
        at = 0
        while True:
            if inside:
                at = self._closed(line, at)
                if at < 0:
                    return True
                at = line.find(self.sep, at)
                if at < 0:
                    return False
                at += len(self.sep)
            if not line.startswith(self.quote, at):
                at = line.find(self.sep + self.quote, at)
                if at < 0:
                    return False
                at += len(self.sep)
            at += len(self.quote)
            inside = True

    def fields(self, record: str) -> list[str]:
        kind = {"doublequote": True} if self.escape == self.quote else {"doublequote": False, "escapechar": self.escape}
        return next(csv.reader([record.removeprefix("﻿").removesuffix("\r")], delimiter=self.sep, quotechar=self.quote, **kind))


def _runs(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, pa.Array]]:
    """Lines of one block that stand in one batch, with the given columns of the block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, start = (batch[name].to_numpy() for name in ("key", "start"))
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield tuple(batch[name][int(a)].as_py() for name in names), batch["value"].slice(int(a), int(b - a))


def _census(quotes: Quotes | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block; without ``quotes`` every line is a record."""
    block, ends, closes, header, done = None, (False, True), False, [], True

    def row() -> pa.RecordBatch:
        values = dict(zip(("path", "key", "start"), block, strict=True)) | {
            "from_outside": ends[0], "from_inside": ends[1] and quotes is not None, "closes": closes,
            "header": "\n".join(header) if done and header else None, "text": bool(header) or block[2] != 0,
        }
        return pa.RecordBatch.from_pylist([values], _CENSUS_ARROW)

    for name, lines in _runs(batches, "path", "key", "start"):
        if name != block:
            if block is not None:
                yield row()
            block, ends, closes, header, done = name, (False, True), False, [], name[2] != 0
        if not done:
            for line in lines:
                if header or line.as_py() not in _EMPTY:
                    header.append(line.as_py())
                    done = quotes is None or not quotes.after("\n".join(header), False)
                    if done:
                        break
        if quotes is not None:
            for line in lines.filter(pc.match_substring(lines, quotes.quote)).to_pylist():
                ends = tuple(quotes.after(line, inside) for inside in ends)
                closes = closes or not ends[1]
    if block is not None:
        yield row()


@dataclass
class Book:
    """What the census found: layouts (lists of column names), and of each file its layout, its sheet, and its blocks:
    start -> (begins inside quotes, start of the block in which the record open at the beginning began)."""

    layouts: list[tuple[str, ...]] = field(default_factory=list)
    files: dict[int, tuple[int, str, dict[int, tuple[bool, int]]]] = field(default_factory=dict)
    crossing: bool = False


def _book(rows: list, quotes: Quotes) -> Book:
    book, layouts, blocks = Book(), {}, defaultdict(list)
    for row in rows:
        blocks[row.key].append(row)
    for key, members in blocks.items():
        members.sort(key=lambda row: row.start)
        if len({row.path for row in members}) > 1:
            raise ValueError(f"two files share a hash: {sorted({row.path for row in members})}")
        if members[0].header is None:
            if len(members) == 1 and not members[0].text:
                continue  # nothing but empty lines
            raise ValueError(f"the header of {members[0].path} does not end in its first block")
        names = tuple(quotes.fields(members[0].header))
        layout = layouts.setdefault(names, len(layouts))
        inside, owner, states = False, 0, {}
        for row in members:
            states[row.start] = (inside, owner)
            if not inside or row.closes:
                owner = row.start
            inside = row.from_inside if inside else row.from_outside
            book.crossing |= inside
        book.files[key] = (layout, members[0].sheet, states)
    book.layouts = list(layouts)
    return book


class _Block:
    """The lines of one block on their way into records.

    ``held`` are the lines of the record that is open, if ``inside``; its ``owner`` is the block it began in,
    ``piece`` says that it began before this one. Until ``body`` the lines are the header's.
    """

    def __init__(self, quotes: Quotes | None, start: int, inside: bool, owner: int) -> None:
        self.quotes, self.start, self.inside, self.owner = quotes, start, inside, owner
        self.piece, self.body, self.held = inside, start != 0, []

    def _after_header(self, lines: pa.Array) -> int:
        """Place of the first line after the header, which may go on in further lines."""
        for at, line in enumerate(lines.to_pylist()):
            if not self.held and line in _EMPTY:
                continue
            self.held.append(line)
            if self.quotes is None or not self.quotes.after("\n".join(self.held), False):
                self.held, self.body = [], True
                return at + 1
        return len(lines)

    def _close(self) -> tuple[list[str], int | None]:
        found = ["\n".join(self.held)], self.owner if self.piece or self.inside else None
        self.held, self.piece, self.owner = [], False, self.start
        return found

    def add(self, lines: pa.Array) -> Iterator[tuple[pa.Array | list[str], int | None]]:
        """Records, or pieces of one, and the block that owns the pieces; all whole records of ``lines`` at once, since
        a batch for every quoted record would cost far more than the record."""
        at = 0 if self.body else self._after_header(lines)
        if self.quotes is None:
            yield lines.slice(at), None
            return
        marks = np.flatnonzero(pc.match_substring(lines, self.quotes.quote).to_numpy(zero_copy_only=False))
        marks = marks[np.searchsorted(marks, at):]
        alone, joined, after = np.ones(len(lines), bool), [], self.quotes.after
        alone[:at] = False
        for mark, line in zip(marks.tolist(), lines.take(pa.array(marks)).to_pylist(), strict=True):
            ends_inside = after(line, self.inside)
            if self.inside:
                if mark > at:
                    self.held += lines.slice(at, mark - at).to_pylist()
                self.held.append(line)
                alone[at:mark + 1] = False
                at = mark + 1
                self.inside = ends_inside
                if not ends_inside:
                    records, owner = self._close()
                    if owner is None:
                        joined += records
                    else:
                        yield records, owner
            elif ends_inside:
                self.held, self.inside, self.owner = [line], True, self.start
                alone[mark] = False
                at = mark + 1
        if self.inside:
            self.held += lines.slice(at).to_pylist()
            alone[at:] = False
        plain = lines.filter(pa.array(alone))
        yield (pa.concat_arrays([plain, pa.array(joined, plain.type)]) if joined else plain), None

    def end(self) -> Iterator[tuple[list[str], int | None]]:
        if self.body and self.held:
            yield self._close()


def _records(shared, quotes: Quotes | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block; those that cross its borders as pieces with the block that owns them."""
    files, name, block = shared.value, None, None

    def rows(found) -> Iterator[pa.RecordBatch]:
        for records, owner in found:
            n = len(records)
            yield pa.record_batch({
                "layout": pa.repeat(pa.scalar(files[name[0]][0], pa.int32()), n),
                "sheet": pa.repeat(pa.scalar(files[name[0]][1], pa.string()), n),
                "record": pa.array(records, pa.string()) if isinstance(records, list) else records,
                "owner": pa.array([owner] * n, pa.int64()) if owner is not None else pa.nulls(n, pa.int64()),
                "start": pa.repeat(pa.scalar(name[1], pa.int64()), n),
                "key": pa.repeat(pa.scalar(name[0], pa.int64()), n),
            })

    for found, lines in _runs(batches, "key", "start"):
        if found != name:
            if block is not None:
                yield from rows(block.end())
            name, block = found, None
            if name[0] in files:
                if name[1] not in files[name[0]][2]:
                    raise ValueError("the blocks changed between two scans; read again")
                block = _Block(quotes, name[1], *files[name[0]][2][name[1]])
        if block is not None:
            yield from rows(block.add(lines))
    if block is not None:
        yield from rows(block.end())


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    path = F.col("_metadata.file_path")
    return reader.text(paths).select("value", path.alias("path"), F.xxhash64(path).alias("key"), F.col("_metadata.file_block_start").alias("start"))


@dataclass(frozen=True)
class Records:
    """Written records, one layout after another."""

    records: DataFrame
    layouts: list[tuple[str, ...]]
    options: dict[str, str]

    def parsed(self) -> list[tuple[tuple[str, ...], DataFrame]]:
        """Per layout its column names and ``sheet, record, fields``: fields ``c0, c1, ...`` and ``malformed``, the
        record itself where it has too few or too many fields, null in all others."""
        options = {k: v for k, v in self.options.items() if k not in ("header", "delimiter")}
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "multiLine": "true"}
        found = []
        for layout, names in enumerate(self.layouts):
            schema = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{_BAD} string"])
            rows = self.records.where(F.col("layout") == layout)
            found.append((names, rows.select("sheet", "record", F.from_csv("record", schema, options).alias("fields"))))
        return found


def read_records(
    spark: SparkSession, paths: list[str], sheet: Column | Mapping[str, str], options: Mapping[str, str], folder: str | None = None
) -> Records:
    """The records of the CSV files below ``paths``, written to a scratch folder.

    ``sheet`` names the sheet of a file from its column ``path``.
    """
    quotes = Quotes(options.get("sep", options.get("delimiter", ",")), options.get("quote", '"'), options.get("escape", '"'))
    breaks = quotes if str(options.get("multiLine", "true")).lower() == "true" else None
    lines = _lines(spark, paths)
    census = lines.mapInArrow(partial(_census, breaks), _CENSUS)
    book = _book(census.withColumn("sheet", sheet).collect(), quotes)  # one row per block
    folder = folder or scratch_path(spark, "records")
    split = lines.select("value", "key", "start").mapInArrow(
        partial(_records, spark.sparkContext.broadcast(book.files), breaks), _RECORDS
    )
    split.write.partitionBy("layout").parquet(folder)
    written = spark.read.schema("sheet string, record string, owner long, start long, key long, layout int").parquet(folder)
    records = written.where("owner IS NULL").select("layout", "sheet", "record")
    if book.crossing:
        pieces = written.where("owner IS NOT NULL").groupBy("layout", "sheet", "key", "owner")
        joined = pieces.agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("pieces"))
        record = F.array_join(F.transform("pieces", lambda p: p["record"]), "\n")
        records = records.union(joined.select("layout", "sheet", record.alias("record")))
    plain = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return Records(records.withColumn("record", plain).where("record <> ''"), book.layouts, dict(options))
