"""Toxicity scores against a plain FTRL over a dictionary of weights."""

import math
import random
import re
import zlib
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest

from tallyhouse.llm import toxicity
from tallyhouse.llm.queries import QUERIES
from tests.conftest import SMALL

OPTIONS = toxicity.ToxicityOptions(bits=16, l1=2.0, passes=3)
DOCS = "doc_id long, text string, id string, score double, label string"


def _mixed(value):
    cut = (1 << 64) - 1
    value = ((value ^ (value >> 31)) * 0x9E3779B97F4A7C15) & cut
    return (((value ^ (value >> 29)) * 0xBF58476D1CE4E5B9) & cut) >> (64 - OPTIONS.bits)


def _features(text):
    words = re.findall(r"\w+", (text or "").lower())
    codes = [zlib.crc32(w.encode()) << 32 | zlib.crc32(w.encode(), 0x5BD1E995) for w in words]
    found = {_mixed(c) for c in codes}
    for gap in (1, 2, 3):
        found |= {
            _mixed((a * 0x2545F4914F6CDD1D + b + gap) % (1 << 64)) for a, b in zip(codes, codes[gap:], strict=False)
        }
    return sorted(found)


def _plain(examples):
    """Weights and intercept, one example and one coordinate at a time."""
    o, z, n = OPTIONS, defaultdict(float), defaultdict(float)
    share = min(max(sum(y for _, y in examples) / len(examples), 0.01), 0.99)
    prior = math.log(share / (1 - share))

    def weight(i):
        if i == -1:
            return -z[i] / ((o.beta + math.sqrt(n[i])) / o.alpha + o.l2)
        if abs(z[i]) <= o.l1:
            return 0.0
        return -(z[i] - math.copysign(o.l1, z[i])) / ((o.beta + math.sqrt(n[i])) / o.alpha + o.l2)

    order = np.random.default_rng(1)
    for _ in range(o.passes):
        for k in order.permutation(len(examples)):
            found, y = examples[k]
            margin = sum(weight(i) for i in found) + prior + weight(-1)
            g = 1 / (1 + math.exp(-min(max(margin, -35), 35))) - y
            for i, w in [(i, weight(i)) for i in [*found, -1]]:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / o.alpha * w
                n[i] += g * g
    return {i: weight(i) for i in z if i != -1 and weight(i)}, prior + weight(-1)


def _corpus(count, seed=3):
    chance = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = [f"w{int(chance.paretovariate(0.7)) % 400}" for _ in range(chance.randrange(1, 60))]
        bad = chance.random() < 0.3
        if bad:
            words.insert(chance.randrange(len(words) + 1), chance.choice(["Vile", "nasty"]))
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, int(bad)))
    return rows, labels


def test_weights_and_scores_equal_plain_ftrl(spark):
    rows, labels = _corpus(150)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(spark, docs, known, OPTIONS)
    usable = [(_features(rows[i][1]), y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    usable.sort(key=lambda one: (toxicity.digest(np.array(one[0])), one[1]))
    weights, intercept = _plain(usable)
    assert list(model.at) == sorted(weights) and 0 < len(weights)
    assert np.allclose(model.weight, [weights[i] for i in sorted(weights)], atol=1e-9)
    assert model.intercept == pytest.approx(intercept, abs=1e-9)
    extra = [(900, None, "x", 1.0, "y"), (901, "", None, None, None), (902, "--- !!", None, None, None),
             (None, "nasty " * 50_000, None, None, None), (0, rows[0][1], None, None, None)]
    for row in toxicity.score(spark, spark.createDataFrame(rows + extra, DOCS), model, OPTIONS).collect():
        text = rows[row.doc_id][1] if row.doc_id is not None and row.doc_id < 150 else "nasty " * 4 if row.doc_id is None else ""
        margin = intercept + sum(weights.get(i, 0.0) for i in _features(text))
        assert row.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_shards_are_averaged(spark):
    rows, labels = _corpus(400)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(spark, docs, known, replace(OPTIONS, shard=100))
    scores = {r.doc_id: r.score for r in toxicity.score(spark, docs, model, OPTIONS).collect()}
    held = {r[0]: r[1] for r in docs.select("doc_id", toxicity.held_out()).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in labels}
    bad, good = ([scores[i] for i, y in labels if held[i] and y == k] for k in (1, 0))
    assert sum(b > g for b in bad for g in good) / (len(bad) * len(good)) > 0.95


def test_unusable_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(0, "a b", None, None, None), (0, "a b", None, None, None), (None, None, None, None, None)], DOCS)
    for labels in ([], [(0, None), (None, 1), (77, 1)]):
        model = toxicity.train(spark, docs, spark.createDataFrame(labels, "doc_id long, toxic int"), OPTIONS)
        assert [r.score for r in toxicity.score(spark, docs, model, OPTIONS).collect()] == [0.5] * 3
    assert toxicity.score(spark, docs.limit(0), model, OPTIONS).count() == 0
    conflicting = spark.createDataFrame([(0, 0), (0, 1)], "doc_id long, toxic int")
    assert toxicity.train(spark, docs, conflicting, OPTIONS).intercept > 0


def test_other_column_names(spark):
    docs = spark.createDataFrame([(3, "nasty", 1)], "`a.b` long, `the text` string, label int")
    model = toxicity.Weights(np.array([_features("nasty")[0]]), np.array([2.0]), -1.0)
    scored = toxicity.score(spark, docs, model, OPTIONS, id_column="`a.b`", text_column="`the text`")
    assert scored.first().score == pytest.approx(1 / (1 + math.exp(-1.0)))


def test_query(spark):
    rows = QUERIES["op13_toxicity"](spark, SMALL).collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
