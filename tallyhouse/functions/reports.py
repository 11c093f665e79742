"""Long ``(metric, value)`` reports built from one-row aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gather(frames: Sequence[DataFrame]) -> DataFrame:
    """Put several one-row frames with distinct columns side by side.

    A union and a maximum per column; every other row holds null there.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def long_report(
    row: DataFrame, metrics: Sequence[tuple[str, Column]], value_type: str
) -> DataFrame:
    """One output row per metric, in the given order."""
    cells = [cell for label, value in metrics for cell in (F.lit(label), value.cast(value_type))]
    return row.select(F.stack(F.lit(len(metrics)), *cells).alias("metric", "value"))


def money_as_double(frame: DataFrame) -> DataFrame:
    """Decimal columns as double, the type reports hand out."""
    return frame.select(*[
        F.col(f"`{name}`").cast("double").alias(name) if kind.startswith("decimal") else F.col(f"`{name}`")
        for name, kind in frame.dtypes
    ])
