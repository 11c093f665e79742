"""CSV reports and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def _plain(frame: DataFrame) -> DataFrame:
    """Numbers and times as people write them.

    Doubles in reports are rounded to two digits or fewer; as decimals they do
    not turn into powers of ten. Times get no T between date and hour.
    """
    kinds = {"double": "decimal(28,2)", "timestamp_ntz": "string"}
    return frame.select(*[
        F.col(f"`{name}`").cast(kinds[kind]).alias(name) if kind in kinds else F.col(f"`{name}`")
        for name, kind in frame.dtypes
    ])


def write_csv(frame: DataFrame, path: str, *order: Column) -> None:
    """Write with a header, in the frame's order or sorted by ``order``.

    Never squeezed into one task: a sort is a range-partitioned one whose part
    files follow each other, and small results come out as one file anyway.
    """
    ordered = frame.orderBy(*order) if order else frame
    _plain(ordered).write.mode("overwrite").options(**_CSV).csv(path)
