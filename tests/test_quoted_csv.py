"""Quoted line breaks across block borders, against Spark's own whole-file reader."""

import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import quoted_csv
from tallyhouse.sources.quoted_csv import Quotes, read_records

OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
TRICKY = (
    'a,b,c\n1,"two\nlines",3\n4,"say ""hi""\n\n""x""",5\n6,5" pipe,7\n"8","","9"\r\n\n'
    '10,"a,b\n,""\n"" \nq",11\n12,"ab"cd,13\n14,Größe "no" quote,15\n"\n\n\n",16,17\n18,,\n19,"x\r\ny",20'
)


def _cut(lines, cuts):
    """Blocks of lines with their first line as start."""
    return [(a, lines[a:b]) for a, b in zip([0, *cuts], [*cuts, len(lines)], strict=True) if a < b]


def _joined(text, cuts, quotes=Quotes(), batch=1000):
    """Both scans over the blocks, in plain Python."""

    def batches(names):
        for start, lines in _cut(text.split("\n"), cuts):
            for i in range(0, len(lines), batch):
                part = lines[i : i + batch]
                columns = {"value": part, "path": ["f"] * len(part), "key": [7] * len(part), "start": [start] * len(part)}
                yield pa.record_batch({name: columns[name] for name in names})

    class Row(dict):
        __getattr__ = dict.__getitem__

    rows = [Row(r, sheet="s") for b in quoted_csv._census(quotes, batches(("value", "path", "key", "start"))) for r in b.to_pylist()]
    random.Random(1).shuffle(rows)
    book = quoted_csv._book(rows, quotes)

    class Shared:
        value = book.files

    whole, pieces = [], {}
    for found in quoted_csv._records(Shared, quotes, batches(("value", "key", "start"))):
        for row in found.to_pylist():
            if row["owner"] is None:
                whole.append(row["record"])
            else:
                pieces.setdefault(row["owner"], []).append((row["start"], row["record"]))
    assert bool(pieces) <= book.crossing
    whole += ["\n".join(record for _, record in sorted(members)) for members in pieces.values()]
    return book.layouts, sorted(r for r in whole if r not in ("", "\r"))


def test_every_cut_gives_the_same_records():
    lines = TRICKY.split("\n")
    layouts, records = _joined(TRICKY, [])
    assert layouts == [("a", "b", "c")] and len(records) == 10
    for cut in range(1, len(lines)):
        assert _joined(TRICKY, [cut]) == (layouts, records)
        assert _joined(TRICKY, [cut], batch=2) == (layouts, records)
    for first in range(1, len(lines) - 1):
        for second in range(first + 1, len(lines)):
            assert _joined(TRICKY, [first, second]) == (layouts, records)
    assert _joined(TRICKY, list(range(1, len(lines)))) == (layouts, records)


@pytest.mark.parametrize("seed", range(30))
def test_random_records(seed):
    chance = random.Random(seed)
    rows = [["".join(chance.choice('ab",\n \r') for _ in range(chance.randrange(6))) for _ in range(3)] for _ in range(40)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=chance.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows([["x", "y", "z"], *rows])
    text = out.getvalue().removesuffix("\n")
    cuts = sorted(chance.sample(range(1, text.count("\n") + 1), min(12, text.count("\n"))))
    expected = sorted(row for row in rows if any(row))
    if cuts[0] < 1 + text.split("\n")[0].count("\n"):
        return
    layouts, records = _joined(text, cuts, batch=chance.choice([1, 3, 1000]))
    found = [next(csv.reader(io.StringIO(record, newline=""))) for record in records]
    assert layouts == [("x", "y", "z")] and sorted(row for row in found if any(row)) == expected


def test_other_escapes():
    quotes = Quotes(sep=";", quote="'", escape="\\")
    assert quotes.after("a;'b\\'", False) and not quotes.after("a;'b\\\\'", False)
    assert not quotes.after("c';d", True) and quotes.after("c';'d", True) and not quotes.after("it's; so", False)
    assert quotes.fields("a;'b;c'") == ["a", "b;c"]


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("size", [9, 23, 40, 64, 101, 1000])
def test_blocks_of_any_size_read_like_one_split(spark, tmp_path, size):
    (tmp_path / "f.csv").write_bytes(TRICKY.encode())
    whole = spark.read.options(**OPTIONS).csv(str(tmp_path / "f.csv"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert quoted_csv._lines(spark, [str(tmp_path)]).rdd.getNumPartitions() >= len(TRICKY.encode()) // size
        ((names, rows),) = read_records(spark, [str(tmp_path)], F.lit("s"), OPTIONS).parsed()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert names == ("a", "b", "c")
    assert _rows(rows.select("fields.c0", "fields.c1", "fields.c2")) == _rows(whole)


def test_malformed_lines_are_marked(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,2\n3\n4,5,6\n"open,7')
    ((_, rows),) = read_records(spark, [str(tmp_path)], F.lit("s"), OPTIONS).parsed()
    assert _rows(rows.select("fields.malformed").where("fields.malformed IS NOT NULL")) == [('"open,7',), ("3",), ("4,5,6",)]


def test_empty_files_headers_alone_and_bad_headers(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n")
    assert read_records(spark, [str(tmp_path)], F.lit("s"), OPTIONS).parsed() == []
    (tmp_path / "head.csv").write_text("\n\n﻿a,b")
    ((names, rows),) = read_records(spark, [str(tmp_path)], F.lit("s"), OPTIONS).parsed()
    assert names == ("a", "b") and rows.count() == 0
    (tmp_path / "bad.csv").write_text('a,"b\n1,2\n')
    with pytest.raises(ValueError, match="header"):
        read_records(spark, [str(tmp_path)], F.lit("s"), OPTIONS)


def test_plain_lines(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x"\n2,5"\n')
    ((_, rows),) = read_records(spark, [str(tmp_path)], F.lit("s"), OPTIONS | {"multiLine": "false"}).parsed()
    assert _rows(rows.select("fields.c0", "fields.c1")) == [("1", "x"), ("2", '5"')]


def test_quoted_records_share_batches():
    """A batch of its own for every record with a line break costs far more than the record."""
    text = "a,b\n" + "\n".join(f'{i},"x\ny"\n{i},z' for i in range(500))
    lines = text.split("\n")
    batch = pa.record_batch({"value": lines, "key": [7] * len(lines), "start": [0] * len(lines)})

    class Shared:
        value = {7: (0, "s", {0: (False, 0)})}

    found = [b for b in quoted_csv._records(Shared, Quotes(), iter([batch])) if b.num_rows]
    assert sum(b.num_rows for b in found) == 1000 and len(found) <= 3
