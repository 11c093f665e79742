"""Rows at given places of a sort order, without sorting: histogram refinement.

The order is an integer first, then a text that tells equal integers apart. A place is
searched in a range of values. Every round counts the rows per part of each range, in one
pass with a partial count per task, and goes on in the part that holds the place: one of
``parts`` slices of a range of integers, or, once the integer is settled, one prefix of the
texts, two characters longer than the last. A range of 2^b values takes at most b / 10 + 1
rounds of 1024 parts, a text of n characters n / 2 + 1. As soon as no range holds more than
``few`` rows, they are fetched and the rest is done at once. What reaches the driver in a
round is one count per part, at the end ``few`` rows per place at most.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEP = 2  # characters by which a prefix grows


@dataclass(frozen=True)
class _Range:
    """Values ``low`` to ``high`` of a column; with a ``prefix``, the one value whose texts begin so. ``before`` rows
    come earlier, ``size`` rows are in it."""

    column: str
    low: int
    high: int
    before: int
    size: int
    prefix: str = ""
    exact: bool = False  # the prefix is the whole text, so all rows are equal

    def holds(self, tie: str) -> Column:
        value = F.col(f"`{self.column}`")
        inside = (value >= F.lit(self.low)) & (value <= F.lit(self.high))
        return inside & F.startswith(F.col(tie), F.lit(self.prefix)) if self.prefix else inside

    def part(self, tie: str, parts: int) -> Column:
        """Where in the range a row is, as text: a number or a longer prefix."""
        if self.low == self.high:
            return F.substring(F.col(tie), 1, len(self.prefix) + _STEP)
        width = -(-(self.high - self.low + 1) // parts)
        offset = F.col(f"`{self.column}`").cast("decimal(38,0)") - F.lit(str(self.low)).cast("decimal(38,0)")
        return F.call_function("div", offset, F.lit(str(width)).cast("decimal(38,0)")).cast("string")

    def narrowed(self, counts: Mapping[str, int], place: int, parts: int) -> _Range:
        """The part that holds ``place``."""
        by_text = self.low == self.high
        before = self.before
        for part in sorted(counts, key=str if by_text else int):
            if place <= before + counts[part]:
                break
            before += counts[part]
        found = replace(self, before=before, size=counts[part])
        if by_text:
            return replace(found, prefix=part, exact=len(part) < len(self.prefix) + _STEP)
        width = -(-(self.high - self.low + 1) // parts)
        low = self.low + int(part) * width
        return replace(found, low=low, high=min(self.high, low + width - 1))


def rows_in_order(
    frame: DataFrame, tie: str, places: Mapping[str, Sequence[int]], few: int = 2000, parts: int = 1024
) -> dict[str, list[tuple[int, str]]]:
    """(value, text) at the given places, 1 to the number of rows, in the order of (column, ``tie``), per integer
    column. Columns and ``tie`` hold no nulls. ``frame`` should be a written table: it is read once per round."""
    ends = frame.agg(
        F.count(F.lit(1)), *[f(F.col(f"`{column}`").cast("bigint")) for column in places for f in (F.min, F.max)]
    ).first()
    whole = {
        column: _Range(column, *ends[1 + 2 * i : 3 + 2 * i], 0, ends[0]) for i, column in enumerate(places)
    }
    state = {(column, place): whole[column] for column, wanted in places.items() for place in wanted}
    while True:
        open_ = sorted({r for r in state.values() if r.size > few and not r.exact}, key=repr)
        if not open_:
            break
        entries = F.array(*[
            F.when(r.holds(tie), F.struct(F.lit(i).alias("range"), r.part(tie, parts).alias("part")))
            for i, r in enumerate(open_)
        ])
        counted = (
            frame.select(F.explode(F.array_compact(entries)).alias("at"))
            .groupBy("at.range", "at.part").agg(F.count(F.lit(1)).alias("n")).collect()
        )
        counts: dict[_Range, dict[str, int]] = defaultdict(dict)
        for row in counted:
            counts[open_[row.range]][row.part] = row.n
        for at, r in state.items():
            if r in counts:
                state[at] = r.narrowed(counts[r], at[1], parts)
    found = {at: (r.low, r.prefix) for at, r in state.items() if r.exact}
    rest = sorted({r for r in state.values() if not r.exact}, key=repr)
    if rest:
        entries = F.array(*[
            F.when(r.holds(tie), F.struct(F.lit(i).alias("range"), F.col(f"`{r.column}`").cast("bigint").alias("value"), F.col(tie).alias("text")))
            for i, r in enumerate(rest)
        ])
        rows: dict[_Range, list[tuple[int, str]]] = defaultdict(list)
        for row in frame.select(F.inline(F.array_compact(entries))).collect():
            rows[rest[row.range]].append((row.value, row.text))
        for at, r in state.items():
            if not r.exact:
                found[at] = sorted(rows[r])[at[1] - r.before - 1]
    return {column: [found[column, place] for place in wanted] for column, wanted in places.items()}
