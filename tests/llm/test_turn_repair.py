"""Conversation repair against exhaustive and row-by-row search in plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tallyhouse.llm import turn_repair
from tallyhouse.llm.turn_repair import SegmentLimits, repair, repair_damaged, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, place int, audit string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def _ordered(rows):
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda row: (row[0] is not None, row[0] or 0, row[1], _md5(row[2])))


def _faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def _cheapest(rows, faults):
    """Least (cost, audit, roles and texts), from the last row to the first, one string per state."""
    accepts = {"": True, "s": False, "u": False, "a": True}
    steps = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {q: (0, "", ()) if ok else None for q, ok in accepts.items()}

    def closed(best):
        for _ in range(4):
            for q, step in steps.items():
                if best[step]:
                    cost, audit, turns = best[step]
                    name = {"u": "user", "a": "assistant"}[step]
                    best[q] = min(filter(None, [best[q], (cost + 3, "I" + audit, (f"{name}:", *turns))]), key=lambda b: b[:2])
        return best

    best = closed(best)
    for (_, role, text), bad in reversed(list(zip(rows, faults, strict=True))):
        before = {}
        for q, step in steps.items():
            options = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
            if bad not in ("blank", "duplicate"):
                extra = 3 if bad == "truncated" else 0
                if role[:1] == step or (role[:1] == "s" and q == ""):
                    cost, audit, turns = best[role[0]]
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *turns)))
                cost, audit, turns = best[step]
                name = {"u": "user", "a": "assistant"}[step]
                options.append((cost + extra + 3, "R" + audit, (f"{name}:{text}", *turns)))
            before[q] = min(options, key=lambda b: b[:2])
        best = closed(before)
    return best[""]


def _plain(rows):
    rows = _ordered(rows)
    faults = _faults(rows)
    cost, audit, turns = _cheapest(rows, faults)
    known = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(turns).encode()).hexdigest(),
    )


def _conversations(seed, sizes):
    chance = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "a"]
    texts = ["Yes.", "No!", "cut", "  ", "", None, "What? ", "zwei Wörter", "end.\n\t"]
    return {
        i: [
            (
                None if chance.random() < 0.05 else chance.randrange(max(1, size)),
                chance.choice(roles[: chance.choice([2, 5, 10])]),
                chance.choice(texts) if chance.random() < 0.4 else f"text {chance.randrange(size * 2)}{chance.choice('.!?x')}",
            )
            for _ in range(size)
        ]
        for i, size in enumerate(sizes)
    }


def _frame(spark, conversations):
    rows = [(c, t, r, x, "clash", 1, 2, "no") for c, rows in conversations.items() for t, r, x in rows]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_plain_search_is_exhaustive():
    """The yardstick itself, on short conversations, against all sequences of edits."""
    chance = random.Random(5)
    for _ in range(60):
        rows = [
            (i, chance.choice(["user", "assistant", "system", "tool"]), chance.choice(["a.", "b.", "c", ""]))
            for i in range(chance.randrange(0, 4))
        ]
        faults, found = _faults(rows), []

        def extend(at, initials, cost, audit, rows=rows, faults=faults, found=found):
            if cost > 16 or len(audit) > 8:
                return
            if at == len(rows) and GRAMMAR.fullmatch(initials):
                found.append((cost, audit))
            for new in "ua":
                extend(at, initials + new, cost + 3, audit + "I")
            if at < len(rows):
                extend(at + 1, initials, cost + 4, audit + "D")
                if faults[at] not in ("blank", "duplicate"):
                    extra = 3 if faults[at] == "truncated" else 0
                    extend(at + 1, initials + rows[at][1][0], cost + extra, audit + "K")
                    for new in "ua":
                        extend(at + 1, initials + new, cost + extra + 3, audit + "R")

        extend(0, "", 0, "")
        assert min(found) == _cheapest(rows, faults)[:2]


@pytest.mark.parametrize("limits", [SegmentLimits(), SegmentLimits(rows=3), SegmentLimits(rows=2, characters=15)])
def test_equals_plain_search(spark, limits):
    conversations = _conversations(1, [1, 2, 3, 4, 5, 7, 9, 12, 20, 60] * 6 + [250])
    conversations[None] = conversations[9]
    conversations[900] = [(5, "user", "Same.")] * 40 + [(6, "assistant", "")]
    conversations[901] = [(None, None, None)] * 3
    conversations[902] = [(0, "user", "long " * 50_000)]
    found = {r.conv_id: tuple(r)[1:] for r in repair(spark, _frame(spark, conversations), limits).collect()}
    assert found == {c: _plain(rows) for c, rows in conversations.items()}


def test_repaired_turns(spark):
    conversations = _conversations(2, [30, 8, 8, 1])
    turns = repaired_turns(spark, _frame(spark, conversations), SegmentLimits(rows=4))
    rows = sorted(turns.collect(), key=lambda r: (r.conv_id, tuple(r.place)))
    for c, conversation in conversations.items():
        text = "\n".join(f"{r.role}:{r.text}" for r in rows if r.conv_id == c)
        assert hashlib.sha256(text.encode()).hexdigest() == _plain(conversation)[-1]
        assert GRAMMAR.fullmatch("".join(r.role[0] for r in rows if r.conv_id == c))


def test_damage(spark):
    conversations = _conversations(3, [6] * 60 + [1] * 40)
    conversations[None] = conversations[3]
    expected = {}
    for c, rows in conversations.items():
        left = []
        for t, r, x in rows:
            case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            r, x = " " if r is None else r, " " if x is None else x
            new = (t, "user" if case == 4 else r, "" if case == 1 else re.sub("[.!?]", "", x) if case == 2 else x)
            left += [] if case == 0 else [new] * (2 if case == 3 else 1)
        expected[c] = _plain(left)
    found = {r.conv_id: tuple(r)[1:] for r in repair_damaged(spark, _frame(spark, conversations)).collect()}
    assert found == expected
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in found.values()


def test_empty_table_and_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(spark, empty).count() == 0 and repair_damaged(spark, empty).count() == 0
    odd = spark.createDataFrame([("x", 1, "user", "Hi.", 0)], "`a.b` string, t int, who string, `said so` string, conv int")
    found = repair(spark, odd, names=("`a.b`", "t", "who", "`said so`")).first()
    assert (found["a.b"], found.audit, found.cost) == ("x", "KI", 3)


def test_ranks_follow_audits():
    """Least paths of many segments at once equal those of each alone."""
    chance = random.Random(7)
    segments = [
        (bytes(chance.choice([0, 1, 2, 3]) for _ in range(n)), bytes(chance.choice([0, 0, 1, 2, 4]) for _ in range(n)))
        for n in (1, 5, 17, 64)
    ]
    cost = [turn_repair.costs(c, f, turn_repair._END) for c, f in segments]
    together = turn_repair.least_paths(
        b"".join(c for c, _ in segments), b"".join(f for _, f in segments), [len(c) for c, _ in segments],
        np.concatenate(cost), [0] * 4, True,
    )
    alone = [turn_repair.least_paths(c, f, [len(c)], k, [0], True)[0] for (c, f), k in zip(segments, cost, strict=True)]
    assert together == alone
    assert all(int((turn_repair.matrix(c, f) + np.array(turn_repair._END)).min(1)[0]) == k[0, 0] for (c, f), k in zip(segments, cost, strict=True))
