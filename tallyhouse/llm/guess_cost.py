"""Secrets: fixed shapes, and values in credential contexts that are costly to guess.

Three shapes are matched directly: assignments to a credential's name, access
key ids, and long hexadecimal runs. Beyond them, any value that stands in a
credential context (a wider list of names, ``is`` or white space after a colon,
quoted values with any characters) is priced: dynamic programming over its
characters finds the cheapest segmentation into common words, dates, repeats,
keyboard walks and brute-force spans. The price is the decimal logarithm of the
guesses an attacker needs who knows these habits; every value in a credential
context is priced, and those at or above the limit are secrets of kind ``guess``,
beside any fixed shape that covers or crosses them. A scheme such as ``Bearer`` before
the value is no part of it, and neither is the next parameter of a query string.

A brute-force span grows one character at a time, words and dates have a bounded
length, and a walk or a repeat is followed to its end from its start alone, so pricing
is linear in the value. Texts are scanned whole, one
Spark task per split, with no shuffle. Null texts are empty; repeated rows and
null ids each keep their row; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
SPANS = "array<struct<start:int,place:int,kind:string,end:int>>"

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CREDENTIAL = re.compile(
    r"""(?ai:(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key
    |auth(?:orization|[_-]?token)?|bearer|credentials?|client[_-]?secret
    |(?:secret(?:[_-]?access)?|signing|encryption|master|account|storage|shared)[_-]?key)(?![a-z]))
    ["']?\x20{0,8}(?:[:=]|\x20(?ai:is)\x20|\x20(?=["']))\x20{0,8}
    (?:"([^"\n]{6,})"|'([^'\n]{6,})'
    |((?:(?ai:bearer|basic|token)\x20{1,8})?(?:[^\s"'&]|&(?![A-Za-z_][A-Za-z0-9_]*=)){6,}))""",
    re.VERBOSE,
)
#: Stands between a credential's name and its value.
_SCHEME = re.compile(r"(?ai:bearer|basic|token)(?:\x20+|$)")
#: Trailing punctuation of an unquoted value belongs to the sentence.
_TAIL = ".,;:!?)]}>"

#: Common passwords and words in them, the most used first; callers may pass their own list.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome login letmein secret changeme default test guest root user master "
    "dragon monkey shadow sunshine princess football baseball superman batman iloveyou trustno hello freedom "
    "whatever ninja pass word example sample dummy demo temp none null your token key api access private "
    "public client server service database production staging development local host oracle mysql postgres "
    "spring summer autumn winter january february march april june july august september october november "
    "december monday tuesday wednesday thursday friday saturday sunday love star money charlie jordan thomas "
    "michael jennifer hunter killer pepper soccer hockey cookie cheese banana orange purple yellow silver golden"
).split()
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("@4831!0$57", "aaeeiiosst")
_DATE = re.compile(
    r"(?:(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)",
    re.ASCII,
)
#: What one more segment costs an attacker, as a decimal logarithm.
_SEGMENT = log10(2)
_LONGEST_WORD = 24


def _neighbours() -> dict[str, str]:
    near: dict[str, str] = {}
    for row, keys in enumerate(_ROWS):
        for column, key in enumerate(keys):
            around = {keys[c] for c in (column - 1, column + 1) if 0 <= c < len(keys)}
            for other, shift in ((row - 1, (0, 1)), (row + 1, (-1, 0))):
                if 0 <= other < len(_ROWS):
                    around |= {_ROWS[other][column + s] for s in shift if 0 <= column + s < len(_ROWS[other])}
            near[key] = "".join(around)
    return near


_NEAR = _neighbours()


def _alphabet(value: str) -> float:
    """log10 of the characters that brute force tries at each place."""
    size = sum(n for n, found in ((10, r"[0-9]"), (26, r"[a-z]"), (26, r"[A-Z]"), (33, r"[^0-9A-Za-z]")) if re.search(found, value))
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        size = min(size, 16)
    return log10(max(size, 10))


class GuessCost:
    """Prices values; ``words`` are ranked, the most used first."""

    def __init__(self, words: list[str] | tuple[str, ...] = tuple(COMMON_WORDS)) -> None:
        self.words = {word: log10(rank + 1) for rank, word in reversed(list(enumerate(words, 1)))}
        self.longest = min(_LONGEST_WORD, max(map(len, words), default=0))

    def __call__(self, value: str) -> float:
        """log10 of the guesses for ``value``; 0 when it is empty."""
        size = len(value)
        if not size:
            return 0.0
        one = _alphabet(value)
        lower = value.lower()
        if len(lower) != size:
            lower = value
        plain = lower.translate(_LEET)
        infinite = float("inf")
        best = [infinite] * (size + 1)  # up to here, in whole segments
        brute = [infinite] * (size + 1)  # up to here, inside a brute-force span
        best[0] = 0.0
        walked = repeated = 0  # ends of the longest walk and repeat seen from here
        for i in range(size):
            # a brute-force span continues, or starts after a segment
            cost = min(brute[i], best[i] + (_SEGMENT if i else 0.0)) + one
            if cost < brute[i + 1]:
                brute[i + 1] = cost
            if cost < best[i + 1]:
                best[i + 1] = cost
            base = best[i] + (_SEGMENT if i else 0.0)
            for text, extra in ((lower, 0.0), (plain, _SEGMENT)) if plain != lower else ((lower, 0.0),):
                for j in range(i + 2, min(size, i + self.longest) + 1):
                    rank = self.words.get(text[i:j])
                    if rank is not None:
                        case = 0.0 if value[i:j] == lower[i:j] else _SEGMENT
                        best[j] = min(best[j], base + rank + extra + case)
            if date := _DATE.match(value, i):
                digits = sum(c.isdigit() for c in date[0])
                best[date.end()] = min(best[date.end()], base + (log10(120) if digits == 4 else log10(120 * 365)))
            if i >= walked:
                walked = i + 1
                while walked < size and lower[walked] in _NEAR.get(lower[walked - 1], ""):
                    walked += 1
            if walked - i >= 4:
                best[walked] = min(best[walked], base + log10(47) + (walked - i - 1) * log10(2.5))
            if i >= repeated:
                repeated = i + 1
                while repeated < size and value[repeated] == value[i]:
                    repeated += 1
            if repeated - i >= 3:
                best[repeated] = min(best[repeated], base + one + log10(repeated - i))
            for unit in (2, 3, 4):
                chunk = value[i : i + unit]
                if len(chunk) == unit and value.startswith(chunk, i + unit) and len(set(chunk)) > 1:
                    if i >= unit and value.startswith(chunk, i - unit):
                        continue  # seen from the start of the run already
                    end = i + 2 * unit
                    while value.startswith(chunk, end):
                        end += unit
                    best[end] = min(best[end], base + unit * one + log10((end - i) // unit))
        return best[size]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the fixed shapes, in order."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def credential_values(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values in credential contexts."""
    for m in _CREDENTIAL.finditer(text):
        start, end = m.span(m.lastindex)
        if scheme := _SCHEME.match(text[start:end]):
            start += scheme.end()
        if m.lastindex == 3:
            while end > start and text[end - 1] in _TAIL:
                end -= 1
        if end - start >= 6:
            yield start, end


def secret_spans(text: str, price: GuessCost, limit: float) -> tuple[list, list]:
    """The fixed shapes, and all spans."""
    base = base_spans(text)
    more = [(start, 3, end) for start, end in credential_values(text) if price(text[start:end]) >= limit]
    return base, sorted(base + more) if more else base


def _scan(words: tuple[str, ...], limit: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    price = GuessCost(words)
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("place", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    )
    row = lambda spans: [{"start": a, "place": k, "kind": KINDS[k], "end": b} for a, k, b in spans]
    for batch in batches:
        found = [secret_spans(text.as_py(), price, limit) for text in batch["text"]]
        yield pa.record_batch({
            "id": batch["id"],
            "base": pa.array([row(base) for base, _ in found], kind),
            "found": pa.array([row(spans) for _, spans in found], kind),
        })


def find_secrets(
    docs: DataFrame,
    *,
    words: tuple[str, ...] = tuple(COMMON_WORDS),
    limit: float = 10.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, ``base`` and ``found``, sorted arrays of (start, place, kind, end)."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(partial(_scan, words, limit), f"id {kind}, base {SPANS}, found {SPANS}").withColumnRenamed(
        "id", id_column
    )
