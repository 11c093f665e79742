"""Conversation structure repair: cheapest edits, ties settled by prefix-doubling path ranking.

A conversation's rows go by turn (nulls first; equal turns by role, then the MD5 of the
text). Each row has at most one fault, the first of: blank (nothing but ASCII
whitespace), duplicate (role and text seen earlier in the conversation), truncated (the
last character that is not whitespace is none of ``.!?``). Edits keep a row (K, free; 3
if truncated), give it the role user or assistant (R, 3; 6 if truncated), delete it (D, 4;
the only choice for blank and duplicate rows) or insert an empty turn (I, 3), so that role
initials read ``(s?(ua)+)?``.

A node is a place between rows and one of four states: nothing yet, after s, after u,
after a. The cost DP runs backwards over the rows as min-plus steps on four numbers. Arcs
that lose nothing against it are optimal. Every letter leads from a node to one node, so a
node's least audit begins with the least letter among its optimal arcs; nodes are ranked by
the first 1, 2, 4, ... letters of their least audits, each round pairing the rank of a node
with that of the node the doubled pointer leads to, until no audit is longer. The arc whose
letter and target rank are least is taken, and the path is read off the doubled pointers.

Rows are dealt and sorted by ranges of (conversation, turn, ..., a number of the row), so a
conversation of any length, or a row repeated any number of times, spreads over tasks. A
task cuts what it sees into segments of bounded size. A conversation that begins and ends
inside a task as one segment is finished there. The others are at most two a task and the
long ones: their segments are reduced to 4 x 4 min-plus matrices, which are multiplied per
task's range and then over the ranges of a conversation (one row each); costs run back
down the same way, then the states in which paths enter each segment run forward, and every
segment writes its part of the audit and of the repaired rows. Duplicates across segments
are found by one row per text and segment. Only the hash of a repaired conversation, which
is sequential by nature, and its audit, which is one value, stream through one task.

Defined cases: null roles and texts are one space. A role without initial, or with any
other than s, u or a, cannot be kept, only changed or deleted. A null conversation id is a
conversation. An empty table gives an empty result. Texts are read whole. Columns other
than the four named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.scratch import land

_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 40  # stands for no path
_INITIALS = {"s": 1, "u": 2, "a": 3}
_LEGAL = {(1, 2), (2, 3), (3, 2)}
_NEXT = (2, 2, 3, 2)  # the state after a turn that an edit may add or change
_ROLES = {2: "user", 3: "assistant"}
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 4
_END = (0, 6, 3, 0)  # cost of closing a conversation from each state
_LETTERS = (ord("D"), ord("I"), ord("K"), ord("R"))


@dataclass(frozen=True)
class SegmentLimits:
    rows: int = 4096
    characters: int = 4_000_000


# one segment


def fault(text: str) -> int:
    body = text.rstrip(_SPACE)
    return _BLANK if not body else 0 if body[-1] in ".!?" else _TRUNCATED


def _before(after, code: int, flags: int):
    """Costs to go before a row, and before insertions there, from those after it."""
    s, h, u, a = after
    if flags & (_BLANK | _DUPLICATE):
        s, h, u, a = s + 4, h + 4, u + 4, a + 4
    else:
        extra = 3 if flags & _TRUNCATED else 0
        to_u, to_a = u + extra + (0 if code == 2 else 3), a + extra + (0 if code == 3 else 3)
        s = min(s + 4, to_u, h + extra) if code == 1 else min(s + 4, to_u)
        h, u, a = min(h + 4, to_u), min(u + 4, to_a), min(a + 4, to_u)
    u, a = min(u, a + 3), min(a, u + 3)
    return min(s, u + 3), min(h, u + 3), u, a


def costs(codes: bytes, flags: bytes, after) -> np.ndarray:
    """Costs to go at every place of a segment, for each of the four states."""
    found = [tuple(after)]
    for code, flag in zip(reversed(codes), reversed(flags), strict=True):
        found.append(_before(found[-1], code, flag))
    return np.array(found[::-1], np.int64)


def matrix(codes: bytes, flags: bytes) -> np.ndarray:
    """Cheapest way through a segment from each state (row) to each state (column)."""
    columns = []
    for end in range(4):
        after = tuple(0 if state == end else _FAR for state in range(4))
        for code, flag in zip(reversed(codes), reversed(flags), strict=True):
            after = _before(after, code, flag)
        columns.append(after)
    return np.minimum(np.array(columns, np.int64).T, _FAR)


def _arcs(codes: np.ndarray, flags: np.ndarray, cost: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row's four nodes and each letter in ASCII order, the target and whether the arc is optimal."""
    n = len(codes)
    state = np.arange(4)
    here, after = cost[place], cost[place + 1]
    free = (flags & (_BLANK | _DUPLICATE)) == 0
    extra = np.where(flags & _TRUNCATED, 3, 0)
    onward = np.array(_NEXT)
    code = codes[:, None]
    kept = np.where(code == 1, np.where(state == 0, 1, 0), np.where(code == onward[state], code, 0))
    target = np.empty((n, 4, 4), np.int64)
    good = np.empty((n, 4, 4), bool)
    down = (place[:, None] + 1) * 4
    target[..., 0], good[..., 0] = down + state, after + 4 == here
    target[..., 1], good[..., 1] = place[:, None] * 4 + onward, here[:, onward] + 3 == here
    keeps = np.take_along_axis(after, kept, 1) + extra[:, None]
    target[..., 2], good[..., 2] = down + kept, (keeps == here) & (kept > 0) & free[:, None]
    target[..., 3], good[..., 3] = down + onward, (after[:, onward] + 3 + extra[:, None] == here) & free[:, None]
    return target, good


def least_paths(codes: bytes, flags: bytes, sizes: list[int], cost: np.ndarray, starts: list[int], last: bool):
    """For segments laid end to end (``cost`` has one place more than rows for each): (audit, states
    after each letter, exit state) of the least path from state ``starts`` of each.

    ``last`` says that the segments end their conversations, so that what is missing there is inserted.
    """
    ends = np.cumsum(np.array(sizes) + 1) - 1
    base = ends - np.array(sizes)
    place = np.setdiff1d(np.arange(len(cost)), ends, assume_unique=True)
    target, good = _arcs(np.frombuffer(codes, np.uint8), np.frombuffer(flags, np.uint8), cost, place)
    nodes = len(cost) * 4
    letter = np.zeros(nodes, np.int64)
    pointer = np.arange(nodes)
    rows = (place[:, None] * 4 + np.arange(4)).ravel()
    target, good = target.reshape(-1, 4), good.reshape(-1, 4)
    letter[rows] = np.array(_LETTERS)[good.argmax(1)]
    pointer[rows] = np.take_along_axis(target, good.argmax(1)[:, None], 1)[:, 0]
    if last:
        for state in (1, 2):
            letter[ends * 4 + state] = ord("I")
            pointer[ends * 4 + state] = ends * 4 + _NEXT[state]
    rank, doubled = letter, [pointer]
    while True:  # ranks of the first 2^k letters
        ahead = doubled[-1]
        if (ahead[ahead] == ahead).all():
            break
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[ahead], return_inverse=True)
        doubled.append(ahead[ahead])
    # the optimal arc whose letter, then target, ranks least
    keyed = np.where(good, np.array(_LETTERS) * (int(rank.max()) + 1) + rank[target], np.iinfo(np.int64).max)
    doubled[0][rows] = np.take_along_axis(target, keyed.argmin(1)[:, None], 1)[:, 0]
    paths = (base * 4 + np.array(starts))[:, None]
    for step in doubled:
        paths = np.concatenate([paths, step[paths]], axis=1)
    found = []
    for path in paths:
        used = path[: int(np.count_nonzero(letter[path]))]
        after = pointer[used] % 4
        found.append((bytes(letter[used].astype(np.uint8)), after.tolist(), int(path[-1] % 4)))
    return found


def rewritten(audit: bytes, states: list[int], roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits."""
    at, new_roles, new_texts = 0, [], []
    for edit, state in zip(audit, states, strict=True):
        if edit == _LETTERS[1]:
            new_roles.append(_ROLES[state])
            new_texts.append("")
            continue
        if edit != _LETTERS[0]:
            new_roles.append(roles[at] if edit == _LETTERS[2] else _ROLES[state])
            new_texts.append(texts[at])
        at += 1
    return new_roles, new_texts


class Rows:
    """Consecutive rows of one conversation."""

    def __init__(self, conv) -> None:
        self.conv, self.turns, self.roles, self.texts, self.codes, self.flags = conv, [], [], [], bytearray(), bytearray()
        self.seen: set[tuple[str, str]] = set()
        self.characters = 0

    def add(self, turn, role: str, text: str) -> None:
        flag = fault(text)
        if flag != _BLANK and (role, text) in self.seen:
            flag = _DUPLICATE
        self.seen.add((role, text))
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(_INITIALS.get(role[:1], 0))
        self.flags.append(flag)
        self.characters += len(text) + len(role)

    def digests(self) -> list[bytes | None]:
        """Hash of role and text where they occur first here; blank rows are no one's duplicate."""
        return [
            None if flag in (_BLANK, _DUPLICATE) else hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
            for role, text, flag in zip(self.roles, self.texts, self.flags, strict=True)
        ]


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _illegal(codes: bytes) -> int:
    return sum(pair not in _LEGAL for pair in zip(codes, codes[1:], strict=False))


def _turn_span(turns: list) -> tuple:
    """First and last turn that is not null, and how many different ones there are; turns are sorted."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _gaps(first, last, distinct: int) -> int:
    return last - first + 1 - distinct if distinct else 0


def _sha(lines: Iterator[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


# what a task does with its range of rows


def _solve_whole(whole: list[Rows], texts: bool) -> Iterator[dict]:
    """Finished conversations."""
    cost = np.concatenate([costs(rows.codes, rows.flags, _END) for rows in whole])
    codes, flags = (b"".join(bytes(getattr(rows, name)) for rows in whole) for name in ("codes", "flags"))
    sizes = [len(rows.codes) for rows in whole]
    paths = least_paths(codes, flags, sizes, cost, [0] * len(whole), last=True)
    base = 0
    for rows, (audit, states, _) in zip(whole, paths, strict=True):
        roles, new = rewritten(audit, states, rows.roles, rows.texts)
        yield {
            "conv": rows.conv,
            "gaps": _gaps(*_turn_span(rows.turns)),
            "blank": rows.flags.count(_BLANK),
            "duplicate": rows.flags.count(_DUPLICATE),
            "truncated": rows.flags.count(_TRUNCATED),
            "illegal": _illegal(rows.codes),
            "cost": int(cost[base, 0]),
            "audit": audit.decode(),
            "repaired_sha256": _sha(f"{role}:{text}" for role, text in zip(roles, new, strict=True)),
        } | ({"roles": roles, "texts": new} if texts else {})
        base += len(rows.codes) + 1


def _segment(rows: Rows) -> dict:
    first, last, distinct = _turn_span(rows.turns)
    return {
        "conv": rows.conv, "codes": bytes(rows.codes), "flags": bytes(rows.flags), "digests": rows.digests(),
        "first_turn": first, "last_turn": last, "n_turns": distinct, "roles": rows.roles, "texts": rows.texts,
    }


def _cut(limits: SegmentLimits, schema: pa.Schema, texts: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    seq, rows, border, waiting, held = 0, None, True, [], 0

    def written(found: list[dict]) -> pa.RecordBatch:
        nonlocal seq
        for one in found:
            one |= {"part": part, "seq": seq}
            seq += 1
        return pa.RecordBatch.from_pylist(found, schema)

    for batch in batches:
        for conv, turn, role, text in zip(*(batch[name].to_pylist() for name in ("conv", "turn", "role", "text")), strict=True):
            if rows is None:
                rows = Rows(conv)
            elif rows.conv != conv:
                if border:
                    yield written([_segment(rows)])
                else:
                    waiting.append(rows)
                    held += len(rows.codes)
                    if held >= limits.rows // 2:
                        yield written(list(_solve_whole(waiting, texts)))
                        waiting, held = [], 0
                rows, border = Rows(conv), False
            elif len(rows.codes) >= limits.rows or rows.characters >= limits.characters:
                yield written([_segment(rows)])
                rows, border = Rows(conv), True
            rows.add(turn, role, text)
    if waiting:
        yield written(list(_solve_whole(waiting, texts)))
    if rows is not None:
        yield written([_segment(rows)])


# conversations in several segments


def _flags(table: pa.Table) -> list[tuple[bytes, bytes]]:
    """Codes and flags of the segments of ``table``, in order, with duplicates of earlier segments marked."""
    found = []
    for row in table.select(["codes", "flags", "again"]).to_pylist():
        flags = bytearray(row["flags"])
        for i in row["again"] or []:
            flags[i] = _DUPLICATE
        found.append((row["codes"], bytes(flags)))
    return found


def _fold(table: pa.Table) -> pa.Table:
    """One row for the segments of one conversation in one range."""
    table = table.sort_by("seq")
    segments, through = _flags(table), None
    for codes, flags in segments:
        one = matrix(codes, flags)
        through = one if through is None else np.minimum((through[:, :, None] + one[None]).min(1), _FAR)
    codes, flags = (b"".join(pieces) for pieces in zip(*segments, strict=True))
    first, last, distinct = _joined_turns(table.select(["first_turn", "last_turn", "n_turns"]).to_pylist())
    return pa.table({
        "c": table["c"][:1], "part": table["part"][:1],
        "through": pa.array([through.ravel().tolist()], pa.list_(pa.int64())),
        "blank": pa.array([flags.count(_BLANK)], pa.int64()),
        "duplicate": pa.array([flags.count(_DUPLICATE)], pa.int64()),
        "truncated": pa.array([flags.count(_TRUNCATED)], pa.int64()),
        "illegal": pa.array([_illegal(codes)], pa.int64()),
        "first_code": pa.array([codes[0]], pa.int32()), "last_code": pa.array([codes[-1]], pa.int32()),
        "first_turn": pa.array([first], pa.int64()), "last_turn": pa.array([last], pa.int64()),
        "n_turns": pa.array([distinct], pa.int64()),
    })


_FOLDED = (
    "c string, part int, through array<bigint>, blank long, duplicate long, truncated long, illegal long, "
    "first_code int, last_code int, first_turn long, last_turn long, n_turns long"
)


def _joined_turns(spans: list[dict]) -> tuple:
    """Span of consecutive spans; a turn that ends one and begins the next counts once."""
    first = last = None
    distinct = 0
    for span in spans:
        if span["n_turns"]:
            distinct += span["n_turns"] - (span["first_turn"] == last)
            first, last = span["first_turn"] if first is None else first, span["last_turn"]
    return first, last, distinct


def _spread(table: pa.Table) -> pa.Table:
    """Costs to go after each range of a conversation, and the conversation's counts beside the first."""
    table = table.sort_by("part")
    rows = table.to_pylist()
    after, behind = np.array(_END, np.int64), []
    for row in reversed(rows):
        behind.append(after.tolist())
        after = (np.array(row["through"]).reshape(4, 4) + after).min(1)
    counts = {name: sum(row[name] for row in rows) for name in ("blank", "duplicate", "truncated", "illegal")}
    counts["illegal"] += sum((a["last_code"], b["first_code"]) not in _LEGAL for a, b in zip(rows, rows[1:], strict=False))
    counts |= {"gaps": _gaps(*_joined_turns(rows)), "cost": int(after[0])}
    blank = [None] * (len(rows) - 1)
    return pa.table({
        "c": table["c"], "part": table["part"], "after": pa.array(behind[::-1], pa.list_(pa.int64())),
        "last": pa.array([False] * len(blank) + [True]),
    } | {name: pa.array([counts[name], *blank], pa.int64()) for name in _COUNTS})


_SPREAD = "c string, part int, after array<bigint>, last boolean, " + ", ".join(f"{name} long" for name in _COUNTS)


def _range_costs(table: pa.Table) -> list[tuple[bytes, bytes, np.ndarray, bool]]:
    """Codes, flags, costs and "ends the conversation" of each segment of a range."""
    segments, after = _flags(table), tuple(table["after"][0].as_py())
    ends, found = table["last"][0].as_py(), []
    for i, (codes, flags) in reversed(list(enumerate(segments))):
        cost = costs(codes, flags, after)
        found.append((codes, flags, cost, ends and i == len(segments) - 1))
        after = tuple(cost[0].tolist())
    return found[::-1]


def _exits(table: pa.Table) -> pa.Table:
    """The state in which a range is left, for each state in which it is entered."""
    table = table.sort_by("seq")
    states = [0, 1, 2, 3]
    for codes, flags, cost, last in _range_costs(table):
        states = [least_paths(codes, flags, [len(codes)], cost, [state], last)[0][2] for state in states]
    return pa.table({"c": table["c"][:1], "part": table["part"][:1], "exits": pa.array([states], pa.list_(pa.int32()))})


def _entries(table: pa.Table) -> pa.Table:
    """The state in which each range of a conversation is entered."""
    table = table.sort_by("part")
    state, found = 0, []
    for exits in table["exits"].to_pylist():
        found.append(state)
        state = exits[state]
    return pa.table({"c": table["c"], "part": table["part"], "entry": pa.array(found, pa.int32())})


def _audits(table: pa.Table) -> pa.Table:
    """Each segment's part of the audit, and the states after its letters."""
    table = table.sort_by("seq")
    state, audits, after = table["entry"][0].as_py(), [], []
    for codes, flags, cost, last in _range_costs(table):
        ((audit, states, state),) = least_paths(codes, flags, [len(codes)], cost, [state], last)
        audits.append(audit.decode())
        after.append(bytes(states))
    return pa.table({"c": table["c"], "part": table["part"], "seq": table["seq"], "audit": pa.array(audits), "states": pa.array(after)})


def _rewrite(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            row["roles"], row["texts"] = rewritten(row["audit"].encode(), list(row["states"]), row["roles"], row["texts"])
            yield pa.RecordBatch.from_pylist([row], schema)


def _hash(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation from its pieces in order."""
    current, audit, digest, begun, conv = None, [], None, False, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"c": current, "conv": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["c"] != current:
                if digest is not None:
                    yield done()
                current, conv, audit, digest, begun = row["c"], row["conv"], [], hashlib.sha256(), False
            audit.append(row["audit"])
            for role, text in zip(row["roles"], row["texts"], strict=True):
                digest.update(f"{'\n' if begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                begun = True
    if digest is not None:
        yield done()


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _pieces(spark: SparkSession, rows: DataFrame, limits: SegmentLimits, texts: bool) -> DataFrame:
    """Finished conversations and segments of others, written."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.md5("text"), F.col("place")]
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([rows.schema["conv"]])
    for name, kind in (
        [("part", "int"), ("seq", "bigint")] + [(name, "bigint") for name in _COUNTS]
        + [("audit", "string"), ("repaired_sha256", "string"), ("codes", "binary"), ("flags", "binary")]
        + [("digests", "array<binary>"), ("first_turn", "bigint"), ("last_turn", "bigint"), ("n_turns", "bigint")]
        + [("roles", "array<string>"), ("texts", "array<string>")]
    ):
        schema = schema.add(name, T.DataType.fromDDL(kind))
    cut = rows.select("conv", "turn", "role", "text").mapInArrow(partial(_cut, limits, _arrow(schema), texts), schema)
    return land(spark, cut, "segments")


def _several(spark: SparkSession, segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rewritten pieces of the conversations that no task finished, and their counts."""
    place = F.struct("part", "seq")
    texts = segments.select("c", "part", "seq", F.posexplode("digests").alias("i", "digest")).where("digest IS NOT NULL")
    first = texts.groupBy("c", "digest").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = texts.join(first, ["c", "digest"]).where(place > F.col("at"))
    again = again.groupBy("c", "part", "seq").agg(F.collect_list("i").alias("again"))  # a segment's rows at most
    compact = segments.select("c", "part", "seq", "codes", "flags", "first_turn", "last_turn", "n_turns")
    compact = land(spark, compact.join(again, ["c", "part", "seq"], "left"), "compact")
    folded = land(spark, compact.groupBy("c", "part").applyInArrow(_fold, _FOLDED), "folded")
    spread = land(spark, folded.groupBy("c").applyInArrow(_spread, _SPREAD), "spread")
    costed = compact.join(spread.select("c", "part", "after", "last"), ["c", "part"])
    exits = land(spark, costed.groupBy("c", "part").applyInArrow(_exits, "c string, part int, exits array<int>"), "exits")
    entries = land(spark, exits.groupBy("c").applyInArrow(_entries, "c string, part int, entry int"), "entries")
    entered = costed.join(entries, ["c", "part"])
    schema = "c string, part int, seq long, audit string, states binary"
    audits = land(spark, entered.groupBy("c", "part").applyInArrow(_audits, schema), "audits")
    joined = segments.select("c", "conv", "part", "seq", "roles", "texts").join(audits, ["c", "part", "seq"])
    pieces = joined.mapInArrow(partial(_rewrite, _arrow(joined.schema)), joined.schema)
    return pieces, spread.where("cost IS NOT NULL").select("c", *_COUNTS)


def _read(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.select(
        F.struct(F.col(conv).alias("v")).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
    )


def _solved(spark, rows, limits, names, texts) -> tuple[DataFrame, DataFrame, DataFrame]:
    pieces = _pieces(spark, _read(rows, *names), limits, texts)
    segments = pieces.where("audit IS NULL").withColumn("c", F.to_json("conv"))
    return pieces.where("audit IS NOT NULL"), *_several(spark, segments)


_NAMES = ("conv_id", "turn", "role", "text")


def repair(
    spark: SparkSession, rows: DataFrame, limits: SegmentLimits = SegmentLimits(), names: tuple[str, str, str, str] = _NAMES
) -> DataFrame:
    """Per conversation: its id, ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    whole, pieces, counts = _solved(spark, rows, limits, names, texts=False)
    schema = T.StructType([pieces.schema["c"], pieces.schema["conv"]]).add("audit", "string").add("repaired_sha256", "string")
    order = ("c", "part", "seq")
    dealt = pieces.select(*order, "conv", "audit", "roles", "texts").repartition("c").sortWithinPartitions(*order)
    hashed = dealt.mapInArrow(partial(_hash, _arrow(schema)), schema)
    columns = [F.col("conv.v").alias(names[0].strip("`")), *_COUNTS, "audit", "repaired_sha256"]
    return whole.select(*columns).union(hashed.join(counts, "c").select(*columns))


def repaired_turns(
    spark: SparkSession, rows: DataFrame, limits: SegmentLimits = SegmentLimits(), names: tuple[str, str, str, str] = _NAMES
) -> DataFrame:
    """The repaired rows: conversation id, ``place`` (their order, with gaps), ``role``, ``text``."""
    whole, pieces, _ = _solved(spark, rows, limits, names, texts=True)
    columns = ["conv", "part", "seq", "roles", "texts"]
    both = whole.select(*columns).union(pieces.select(*columns))
    turns = both.select("conv", "part", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "turn"))
    return turns.select(
        F.col("conv.v").alias(names[0].strip("`")),
        F.struct("part", "seq", "i").alias("place"),
        F.col("turn.roles").alias("role"),
        F.col("turn.texts").alias("text"),
    )


# the damage of the query


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with one in twenty rows each dropped, emptied, cut, repeated, or given to the user."""
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in _NAMES}
    case = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    bare = F.regexp_replace(text["text"], "[.!?]", "")
    return (
        rows.select(
            "conv_id",
            "turn",
            F.when(case == 4, F.lit("user")).otherwise(text["role"]).alias("role"),
            F.when(case == 1, F.lit("")).when(case == 2, bare).otherwise(text["text"]).alias("text"),
            case.alias("case"),
        )
        .where("case <> 0")
        .withColumn("copy", F.explode(F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .drop("case", "copy")
    )


def repair_damaged(spark: SparkSession, rows: DataFrame, limits: SegmentLimits = SegmentLimits()) -> DataFrame:
    """The report of every conversation of ``rows``, also those that lost all their rows."""
    found = repair(spark, damaged(rows), limits).withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
