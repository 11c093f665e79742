"""Row numbers and order statistics over several partitions."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.ordering import block_starts, rows_at, sort_with_place, write_numbered
from tallyhouse.plans.rfm import last_of_bin


@pytest.fixture
def shuffled(spark):
    values = [(random.Random(i).choice([1, 1, 1, 2, 3, None]), f"id{i:05d}") for i in range(3000)]
    return values, spark.createDataFrame(values, "v int, id string").repartition(7)


@pytest.fixture
def many_blocks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers_equal_a_plain_sort(spark, shuffled, many_blocks, tmp_path):
    values, frame = shuffled
    order = [F.col("v").asc_nulls_last(), F.col("id")]
    numbered = write_numbered(spark, frame, order, "n", str(tmp_path / "t"))
    expected = sorted(values, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = {(r.v, r.id): r.n for r in numbered.collect()}
    assert got == {row: n for n, row in enumerate(expected, 1)}
    assert numbered.columns == ["v", "id", "n"]


def test_a_hot_value_is_split(spark, shuffled, many_blocks, tmp_path):
    _, frame = shuffled
    path = str(tmp_path / "t")
    sort_with_place(frame, [F.col("v"), F.col("id")], "row").write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = [size for _, _, size in block_starts(stored, "row")[1]]
    assert len(sizes) == 4 and max(sizes) < 3000 / 2


def test_rows_at(spark, shuffled, many_blocks, tmp_path):
    values, frame = shuffled
    path = str(tmp_path / "t")
    sort_with_place(frame, [F.col("id")], "row").write.parquet(path)
    stored = spark.read.parquet(path)
    total, starts = block_starts(stored, "row")
    rows = rows_at(stored, "row", starts, [1, 777, 3000, 3001])
    assert total == 3000 and len(starts) == 4
    assert {n: r.id for n, r in rows.items()} == {1: "id00000", 777: "id00776", 3000: "id02999"}


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "id string")
    assert write_numbered(spark, frame, [F.col("id")], "n", str(tmp_path / "t")).count() == 0
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert block_starts(stored, "n") == (0, []) and rows_at(stored, "n", [], [1]) == {}


def bins(n):
    ends = last_of_bin(n)
    return [1 + sum(rank > end for end in ends) for rank in range(1, n + 1)]


@pytest.mark.parametrize("n", [*range(2, 400), 999, 2999, 5878, 9999, 15000])
def test_bins_equal_quantile_cuts(n):
    cut = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert bins(n) == list(cut)


def test_bins_equal_the_integer_formula():
    for n in range(2, 3001):
        assert bins(n) == [max(1, (5 * (r - 1) + n - 2) // (n - 1)) for r in range(1, n + 1)]


def test_seven_customers():
    assert [bins(7).count(b) for b in range(1, 6)] == [2, 1, 1, 1, 2]
    assert bins(1) == [1]
