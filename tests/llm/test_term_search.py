"""Ranked search against scores computed term by term in plain Python."""

import math
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np

from tallyhouse.llm import term_search
from tallyhouse.llm.term_search import SearchOptions, search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, score string, item_id string"
ITEMS = "item_id long, text string, doc_id long, rank string"


def _terms(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _plain(docs, items, k):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(_terms(text))
    rows = []
    for item, wanted in asked.items():
        scores = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // length
            total = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted if c[t]
            )
            if total > 0:
                scores.append((-total, i is None, i or 0))
        rows += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


def _found(spark, docs, items, options):
    left = spark.createDataFrame([(i, t, "x", None) for i, t in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(i, t, 7, None) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in search(spark, left, right, options).collect()), key=str)


def _corpus(seed, count):
    chance = random.Random(seed)
    word = lambda: f"w{int(chance.paretovariate(0.6)) % 300}"
    docs = [(i, " ".join(word() for _ in range(chance.randrange(1, 80)))) for i in range(count)]
    docs += [(1000 + i, docs[5][1]) for i in range(30)]  # ties beyond k
    items = [(j, " ".join(word() for _ in range(chance.randrange(1, 25)))) for j in range(25)]
    return docs, items


def test_equals_plain_scores(spark):
    docs, items = _corpus(1, 300)
    docs += [(400, None), (401, ""), (402, "... --"), (None, "w1 W2 w7"), (7, docs[7][1]), (403, "w3 " * 40_000 + "Ünïcode ŒUVRE K x9")]
    items += [(90, None), (91, "?"), (92, "nowhere"), (93, "ünïcode Œuvre ŒUVRE k X9!"), (3, "w2 w2"), (None, "w1,w2;W3")]
    items.append((94, docs[5][1]))
    for options in (SearchOptions(k=10), SearchOptions(k=5, postings=50, pairs=40, salts=3)):
        assert _found(spark, docs, items, options) == _plain(docs, items, options.k)


def test_empty_tables(spark):
    assert _found(spark, [], [(1, "a")], SearchOptions()) == []
    assert _found(spark, [(1, "a")], [], SearchOptions()) == []
    assert _found(spark, [(1, "a"), (2, "b")], [(1, "a")], SearchOptions()) == _plain([(1, "a"), (2, "b")], [(1, "a")], 50)


def test_accumulators_stop_and_lose_nothing():
    chance = np.random.default_rng(2)
    spared = 0
    for _ in range(200):
        size = 400
        terms = []
        for j in range(8):
            places = np.sort(chance.choice(size, int(chance.integers(1, 8 * 2**j)) % size + 1, replace=False))
            terms.append((places, chance.integers(1, 40, len(places)) * 3 ** (8 - j)))
        exact = np.zeros(size, np.int64)
        for places, gains in terms:
            exact[places] += gains
        scores, made = term_search.accumulate(terms, size, 10)
        spared += np.count_nonzero(exact) - made
        ids = chance.permutation(size)
        best = term_search.first_of(exact, ids, 10)
        assert list(term_search.first_of(scores, ids, 10)) == list(best)
        assert list(scores[best]) == list(exact[best]) and set(scores[scores > 0]) <= set(exact)
    assert spared > 10_000


def test_tie_with_the_kth_score_still_gets_an_accumulator():
    terms = [(np.array([1, 2]), np.array([5, 5])), (np.array([0]), np.array([5]))]
    scores, made = term_search.accumulate(terms, 3, 2)
    assert made == 3 and list(term_search.first_of(scores, np.array([0, 1, 2]), 2)) == [0, 1]


def test_options_do_not_change_results(spark):
    docs, items = _corpus(4, 120)
    wide = SearchOptions(k=7)
    assert _found(spark, docs, items, wide) == _found(spark, docs, items, replace(wide, postings=1, pairs=1, salts=1))
