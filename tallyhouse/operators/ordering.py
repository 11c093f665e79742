"""Row numbers and exact order statistics without a one-task sort.

Rows are range-partitioned and sorted, and written once together with where
they stand: the block (output partition) and the place inside it. Blocks
follow each other in sort order, so a running sum over the rows per block, one
entry per partition, turns block and place into a number. Everything after the
write reads the stored columns, so tasks that run again cannot shift them. The
block is one value per file, which costs next to nothing to store and count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

# monotonically_increasing_id() keeps the partition above bit 33.
_PLACE_BITS = 33


def place_columns(prefix: str) -> tuple[str, str]:
    return f"{prefix}_block", f"{prefix}_place"


def sort_with_place(frame: DataFrame, order: Sequence[Column], prefix: str, distinct: bool = False) -> DataFrame:
    """Globally sorted rows with block and place; write them before use.

    ``order`` should tell apart all rows that differ, so that no single value
    holds up one partition. ``distinct`` drops exact copies: if ``order`` is plain columns, copies
    are in one range, and dropping them takes no further shuffle.
    """
    block, place = place_columns(prefix)
    position = F.col("row_position")
    ranged = frame.repartitionByRange(*order)
    return (
        (ranged.dropDuplicates() if distinct else ranged)
        .sortWithinPartitions(*order)
        .withColumn("row_position", F.monotonically_increasing_id())
        .withColumns({
            block: F.shiftright(position, _PLACE_BITS).cast("int"),
            place: position.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
        })
        .drop("row_position")
    )


def _block_sizes(stored: DataFrame, prefix: str) -> DataFrame:
    """Rows per block; at most one entry per partition of the write."""
    block, _ = place_columns(prefix)
    return stored.groupBy(block).agg(F.count(F.lit(1)).alias("block_rows"))


def number_rows(stored: DataFrame, prefix: str, name: str) -> DataFrame:
    """Replace block and place by the row number 1..n."""
    block, place = place_columns(prefix)
    earlier = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = _block_sizes(stored, prefix).select(
        block, F.coalesce(F.sum("block_rows").over(earlier), F.lit(0)).alias("block_start")
    )
    return (
        # Bounded: one row of two numbers per partition of the earlier write.
        stored.join(F.broadcast(starts), block)
        .withColumn(name, F.col("block_start") + F.col(place) + F.lit(1))
        .drop(block, place, "block_start")
    )


def block_starts(stored: DataFrame, prefix: str) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of rows, and (block, rows before it, rows in it) in order."""
    total, starts = 0, []
    for block, size in sorted(map(tuple, _block_sizes(stored, prefix).collect())):
        starts.append((block, total, size))
        total += size
    return total, starts


def rows_at(
    stored: DataFrame,
    prefix: str,
    starts: Sequence[tuple[int, int, int]],
    numbers: Iterable[int],
) -> dict[int, Row]:
    """The rows with the given row numbers, a handful, found by block and place."""
    block, place = place_columns(prefix)
    where = {
        (at, number - before - 1): number
        for number in set(numbers)
        for at, before, size in starts
        if before < number <= before + size
    }
    if not where:
        return {}
    wanted = reduce(
        Column.__or__,
        [(F.col(block) == F.lit(at)) & (F.col(place) == F.lit(inside)) for at, inside in where],
    )
    return {where[row[block], row[place]]: row for row in stored.filter(wanted).collect()}


def write_numbered(
    spark: SparkSession,
    frame: DataFrame,
    order: Sequence[Column],
    name: str,
    scratch: str,
) -> DataFrame:
    """Number ``frame`` 1..n in ``order`` by way of a table at ``scratch``."""
    sort_with_place(frame, order, name).write.mode("overwrite").parquet(scratch)
    return number_rows(spark.read.parquet(scratch), name, name)
