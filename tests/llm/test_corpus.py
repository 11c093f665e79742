"""Operators across documents against brute force."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import cross_polytope, line_rules, partenum, quality_classifier, quotations, warc
from tallyhouse.llm.components import components
from tallyhouse.llm.queries import ORACLES, QUERIES
from tallyhouse.llm.scratch import land, small_batches
from tallyhouse.session import shared_folder
from tests.conftest import SMALL
from tests.llm.test_texts import _brute_pii, _packed_right

SCHEMA = "doc_id long, text string, source string, kept string, id string"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    from checks.compare import connect, difference

    actual = QUERIES[name](spark, SMALL).toArrow()
    assert difference(actual, connect(SMALL).sql(ORACLES[name]).to_arrow_table()) is None


def test_components(spark):
    chance = random.Random(1)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    found = dict(map(tuple, components(spark, spark.createDataFrame(links, "a long, b long")).collect()))
    least = {x: x for pair in links for x in pair}
    for _ in range(70):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert found == {x: c for x, c in least.items() if any(x in p and p[0] != p[1] for p in links)}


# lines


def test_frequent_lines(spark):
    shared = "Shared   FOOTER line of this host"
    own = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{own} {i} x{i}\n{shared.lower() if i % 2 else shared}\n", "a", "clash", None) for i in range(12)]
    rows += [(20, shared, "b", None, None), (21, f"{shared}\n" * 30, "a", None, None)]
    rows += [(30 + i, f"copy {own}", "a", None, None) for i in range(10)]
    rows += [(50, None, "a", None, None), (51, "", None, None, None), (0, rows[0][1], "a", "clash", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    limits = line_rules.LineLimits(min_documents=5, share=1, min_left=30, min_words=5)
    judged = line_rules.apply_rules(spark, docs, limits)
    by_id = {r.doc_id: r for r in judged.collect()}
    assert judged.count() == len(rows) and len(judged.columns) == len(set(judged.columns))
    assert all(by_id[i].n_removed_words == 6 and by_id[i].kept for i in range(12))
    assert by_id[20].n_removed_words == 0  # another host
    assert by_id[21].n_removed_words == 180 and not by_id[21].kept
    assert all(by_id[30 + i].kept for i in range(10))  # copies are one document
    assert not by_id[50].kept and not by_id[51].kept
    text = judged.where("doc_id = 1").select(line_rules.without_lines(F.col("text"), F.col("removed_lines"))).first()[0]
    assert text == f"{own} 1 x1\n"
    assert line_rules.apply_rules(spark, docs.limit(0)).count() == 0


def test_production_limits_at_every_host_size(spark):
    passage, notice = " ".join(f"p{i}" for i in range(60)), "Subscribe to our letter"
    rows = []
    for host, size in (("tiny", 8), ("small", 50), ("hot", 2000)):
        holders = max(5, size // 10)
        for i in range(size):
            own = " ".join(f"{host}{i}x{k}" for k in range(70 if i % 2 else 55))
            text = f"{own}\n{notice}\n{passage}" if i < holders else own
            rows.append((len(rows), text, host, "once" if i < 4 else None, None))
        rows.append((len(rows), f"{passage}\n{notice}\nonly a few words", host, None, None))  # depleted
        rows += [(len(rows) + i, f"{host} {i} " + " ".join(f"r{k}" for k in range(60)) + "\nrare line", host, None, None) for i in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    judged = {r.doc_id: r for r in line_rules.apply_rules(spark, docs).collect()}
    for i, text, *_ in rows:
        gone = 64 if passage in text else 0  # "rare line" has four holders only
        assert judged[i].n_removed_words == gone
        assert not judged[i].base_failed and judged[i].kept == ("only a few words" not in text)


def test_repeated_words(spark):
    texts = ["a b c", "a b c a b c", "x x x x", "a b c d a b c e a b c", "one two", "", "a a a", " ".join("pq" * 3000)]
    docs = spark.createDataFrame([(i, t, "s", None, None) for i, t in enumerate(texts)], SCHEMA)
    for row in line_rules.apply_rules(spark, docs).collect():
        words = texts[row.doc_id].split()
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert (row.n_words, row.n_repeat_words) == (len(words), len(inside))


# Jaccard join


def _shingles(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    if len(found) < words:
        return {tuple(found)}
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def _brute_components(rows, words, percent):
    sets = [(i, _shingles(t, words)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    for _ in range(len(sets)):
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    return least


def _variants(seed):
    """Texts of all sizes with chains of edits around the limit, shared passages, and copies."""
    chance = random.Random(seed)
    word = lambda: f"w{chance.randrange(3000)}"
    passage = [word() for _ in range(40)]
    texts = []
    for size in [1, 2, 3, 4, 5, 6, 8, 9, 10, 12, 15, 20, 25, 30, 40, 60, 100, 150, 300, 600]:
        text = [word() for _ in range(size)]
        for _ in range(8):
            text = list(text)
            for _ in range(chance.randrange(0, 1 + size // 40)):
                text[chance.randrange(len(text))] = word()
            if chance.random() < 0.3:
                text.append(word())
            texts.append(" ".join(text))
        texts.append(" ".join(text + passage))
    texts += [texts[5], texts[40], texts[40].upper(), "", " \n ", None]
    chance.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "words", "percent"), [(1, 4, 85), (2, 5, 80)])
def test_jaccard_components(spark, seed, words, percent):
    texts = _variants(seed)
    rows = [(7 * i % 1009, t, None, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    like = partenum.Likeness(words, percent)
    found = partenum.jaccard_components(spark, docs, like).collect()
    expected = _brute_components([r[:2] for r in rows], words, percent)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {r[0]: len(_shingles(r[1], words)) for r in rows}
    kept = partenum.keep_one(spark, docs, like)
    assert {r.doc_id for r in kept.collect()} == set(expected.values())


def test_jaccard_edges(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (None, None), (4, text), (4, text), (9, text), (8, "other words " * 9), (8, text), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = partenum.jaccard_components(spark, docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == {(None, None), (4, 4), (9, 4), (8, 4), (5, 5)}
    kept = partenum.keep_one(spark, docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 4), (False, 5), (True, 0), (True, 0)]
    assert partenum.keep_one(spark, docs.limit(0)).count() == 0


def test_keep_one_with_odd_names_and_no_tables_left(spark):
    rows = [(i, "one two three four five six", j, j, j) for i in (1, 2, 2) for j in (1, 2)] + [(3, "else", 5, 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, place int, __place int")
    kept = partenum.keep_one(spark, docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    gone = ("partenum-keys", "partenum-sets", "partenum-sketches", "partenum-mixed")
    assert not [name for name in os.listdir(shared_folder(spark)) if name.startswith(gone)]


def test_pairs_hold_one_group_beyond_a_batch(monkeypatch):
    groups = [(sign, low, high) for sign in (3, 8) for low in range(4) for high in range(low, 4)]
    names = ("centre", "low", "high", "block", "id", "label", "n_shingles", "sketch")
    rows = [
        (*group, group[1 + i % 2], 100 * group[1 + i % 2] + i, 100 * group[1 + i % 2] + i, 40, bytes([i % 3] * 64))
        for group in groups
        for i in range(10)
    ]
    table = pa.table({name: list(column) for name, column in zip(names, zip(*rows, strict=True), strict=True)})
    whole = partenum._pairs
    found = lambda out: {pair for b in out for pair in zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True)}
    expected = found(whole(partenum.Likeness(), False, table))
    held = []
    monkeypatch.setattr(partenum, "_pairs", lambda like, closest, rows: held.append(len(rows)) or whole(like, closest, rows))
    for size in (1, 7, 10, 25):
        held.clear()
        out = partenum._across(partenum.Likeness(), False, iter(table.to_batches(max_chunksize=size)))
        assert found(out) == expected and expected
        assert sum(held) == len(rows) and max(held) <= 10 + size


def test_only_wanted_sketches_and_groups_travel_again(spark):
    rows = spark.range(20_000).select("id", F.lit(7).alias("n_shingles"), F.lit(b"x").alias("sketch"))
    wanted = spark.createDataFrame([(5,), (77,), (4242,)], "id long")
    found = partenum._wanted(rows, wanted)
    assert found.columns == rows.columns and {5, 77, 4242} <= {r.id for r in found.collect()}
    assert found.count() < 100
    names = ("centre", "low", "high", "block", "id", "label", "n_shingles", "sketch")
    near = [(3, 0, 0, 0, i, i, 40, bytes(64)) for i in (3, 30, 31)]
    far = [(8, 0, 0, 0, i, i, 40, bytes([i]) * 64) for i in (8, 80, 81)]
    table = pa.table({name: list(column) for name, column in zip(names, zip(*near, *far, strict=True), strict=True)})
    out = pa.Table.from_batches(partenum._across(partenum.Likeness(), True, iter(table.to_batches())))
    assert set(out["centre"].to_pylist()) == {3}


def test_batches_to_and_from_workers_are_bounded(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(1500)]
    rows = pa.record_batch({"id": pa.array(range(1500), pa.int64()), "text": pa.array(texts)})
    out = list(partenum._signs(partenum.Likeness(), iter([rows])))
    widest = max(np.unique(np.concatenate([b["id"].to_numpy() for b in out]), return_counts=True)[1])
    assert max(b.num_rows for b in out) < partenum._ROWS + widest < sum(b.num_rows for b in out)
    assert len({i for b in out for i in b["id"].to_pylist()}) == 1500
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = spark.range(0, 5000, 1, 1).mapInArrow(
        lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long"
    )
    with small_batches(spark, 1024):
        assert max(r.n for r in land(spark, sizes, "sizes").collect()) <= 1024
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_similar_sets_share_a_signature(percent):
    chance = np.random.default_rng(percent)
    bands = partenum.Bands(percent)
    for size in [*range(1, 60), 90, 200, 500, 1500]:
        for _ in range(20 if size < 100 else 5):
            both = chance.integers(0, 2**63, 2 * size + 2, dtype=np.uint64)
            common = size
            most = size * (100 - percent) // percent
            extra = int(chance.integers(0, most + 1))
            x = np.unique(both[:common])
            left = int(chance.integers(0, extra + 1))
            y = np.unique(np.concatenate([both[: common], both[common : common + left]]))
            x = np.unique(np.concatenate([x, both[common + left : common + extra]]))
            union = len(np.union1d(x, y))
            assert 100 * size >= percent * union
            if len(x) == len(y) == size:
                continue
            signs = []
            for grams in (x, y):
                band = bands.band(len(grams))
                signs.append({b: partenum._signatures(grams, bands, b) for b in (band, band + 1)})
            both = signs[0].keys() & signs[1].keys()
            assert any(len(np.intersect1d(signs[0][b], signs[1][b])) for b in both)
            u, v = (partenum._sketch(grams, bands) for grams in (x, y))  # sketches never rule such a pair out
            size = min(len(u), len(v))
            differ = np.count_nonzero(partenum._folded(u, size) != partenum._folded(v, size))
            assert differ <= partenum._most(partenum.Likeness(4, percent), len(x), len(y))


# nearest neighbours


def _exact(rows, queries, most):
    vectors = {i: np.array(v, float) for i, v in rows}
    return {
        q: sorted(((-float(np.sum(vectors[q] * v)), i) for i, v in vectors.items() if i != q))[:most] for q in queries
    }


def test_nearest_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = cross_polytope.nearest(spark, vectors, vectors.where("vec_id % 20 = 0")).collect()
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    exact = _exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    hits = sum((r.vec_id in {i for _, i in exact[r.query_id]}) for r in found)
    assert hits >= 0.9 * 20 * len(exact)
    for query in exact:
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        assert all(r.score == pytest.approx(float(np.dot(*[dict(rows)[i] for i in (query, r.vec_id)]))) for r in own)


def test_nearest_edges(spark):
    chance = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(30)]  # equal vectors: ties by id
    rows += [(100 + i, [float(x) for x in chance.standard_normal(3) * (1 + i)]) for i in range(10)]  # lengths differ
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 1.0]), (203, [float("nan"), 1.0, 1.0]), (204, []), (None, [1.0, 1.0, 1.0])]
    rows.append((5, [1.0, 2.0, 0.5]))
    vectors = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("label", F.lit("x"))
    search = cross_polytope.Search(neighbours=20, tables=8, probes=8, block=4)
    found = cross_polytope.nearest(spark, vectors, vectors.where("vec_id % 5 = 0"), search).collect()
    exact = _exact(rows, [i for i in dict(rows) if i % 5 == 0], 20)
    assert {r.query_id for r in found} == set(exact)
    for query, best in exact.items():  # all axes are probed, so the search is exact
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        assert [r.vec_id for r in own] == [i for _, i in best]
    assert cross_polytope.nearest(spark, vectors.limit(0), vectors.limit(0)).count() == 0


# quotations


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow do I sort a table?"),
        (1, 1, "user", "Another topic entirely."),
        (1, 2, "assistant", ">  how do I  SORT a table?\nUse order by."),
        (1, 3, "user", "> > How do I sort a table?\n> Use order by.\nThanks!"),
        (1, 4, "user", "no quotation"),
        (1, 5, "user", "> never said\nfine"),
        (1, 6, "user", "> Another topic entirely.\n> Use order by.\nboth"),
        (2, 0, "user", None), (2, 7, "user", ""), (2, 7, "user", ""), (None, 1, "user", "> x"), (3, None, "user", "a\n> b"),
    ]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit(9))
    linked = quotations.link_quotations(spark, docs)
    found = {(r.conv_id, r.turn): r for r in linked.collect()}
    assert linked.count() == len(rows)
    place = {k: (r.reply_to, r.thread, r.depth) for k, r in found.items()}
    assert place[1, 0] == (None, 0, 0) and place[1, 1] == (0, 0, 1)
    assert place[1, 2] == (0, 0, 1) and place[1, 3] == (2, 0, 2)
    assert place[1, 4] == (3, 0, 3) and place[1, 5] == (4, 0, 4)
    assert place[1, 6] == (2, 0, 2)  # one line each: the later message
    assert found[1, 3].text == "Thanks!" and found[1, 3].n_linked == found[1, 3].n_quoted == 2
    assert (found[1, 5].n_quoted, found[1, 5].n_linked) == (1, 0)
    assert place[2, 7] == (0, 0, 1) and place[None, 1] == (None, 1, 0) and place[3, None] == (None, None, 0)
    ordered = quotations.in_reply_order(linked).where("conv_id = 1").collect()
    seen = set()
    for row in ordered:
        assert row.reply_to is None or row.reply_to in seen
        seen.add(row.turn)
    assert quotations.link_quotations(spark, docs.limit(0)).count() == 0


def test_passages_of_several_holders_and_wraps(spark):
    x, y, z = "Good morning to everybody on this list", "thanks a lot", "the build breaks on the second machine"
    rows = [
        (1, 0, "user", f"{x}\n{y}\n{z}"),  # holds the whole quotation
        (1, 1, "user", f"{x}\n{y}\nsomething else is the matter here"),
        (1, 2, "user", f"> {x}\n> {y}\n> {z}\nWhich one?"),
        (1, 3, "user", f"> good morning to everybody on\n>   this list THANKS a lot the build\n> breaks on the second machine\nrewrapped"),
        (1, 4, "user", f"> {x}\n> {y}\nboth hold this: the later one"),
        (1, 5, "user", f"> > {z}\n> Which one?\n\n> rewrapped\nnested"),
        (1, 6, "user", f"> {z}\n> {z}\nagain"),
        (2, 0, "user", "one two\nthree four\nfive"), (2, 1, "user", "else"), (2, 2, "user", "> one two three four\nfew words"),
        (2, 2, "user", "> one two three four\nfew words"), (2, 3, "user", ">\n>\nnothing quoted"), (2, 4, "user", ">"),
    ]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    linked = quotations.link_quotations(spark, docs)
    found = {(r.conv_id, r.turn): r for r in linked.collect()}
    reply = {k: r.reply_to for k, r in found.items() if k[1]}
    assert reply == {
        (1, 1): 0, (1, 2): 0, (1, 3): 0, (1, 4): 1, (1, 5): 3, (1, 6): 0, (2, 1): 0, (2, 2): 0, (2, 3): 2, (2, 4): 3
    }
    assert {k: (r.n_quoted, r.n_linked) for k, r in found.items() if r.n_quoted} == {
        (1, 2): (1, 1), (1, 3): (1, 1), (1, 4): (1, 1), (1, 5): (3, 3), (1, 6): (1, 1), (2, 2): (1, 1)
    }
    assert linked.count() == len(rows)


def test_quotations_match_sql_where_messages_quote(spark):
    import duckdb

    from checks.compare import difference

    chance = random.Random(6)
    said, rows = {}, []
    for turn in range(400):
        conv = chance.randrange(3)
        lines = [" ".join(chance.choices("ab cd ef gh ij kl".split(), k=chance.randrange(1, 8))) for _ in range(chance.randrange(0, 4))]
        own = list(lines)
        if said.get(conv) and chance.random() < 0.7:
            some = [chance.choice(said[conv]) for _ in range(chance.randrange(1, 4))]
            lines[:0] = [f"{'>' * chance.choice((1, 1, 2))} {line.upper()}" for line in some]
        said.setdefault(conv, []).extend(own)
        rows.append((conv, turn if chance.random() < 0.97 else None, "user", "\n".join(lines) if chance.random() < 0.97 else None))
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = quotations.link_quotations(spark, docs).toArrow()
    database = duckdb.connect()
    database.register("conversations", docs.toArrow())
    assert difference(found, database.sql(ORACLES["op6_quotations"]).to_arrow_table()) is None
    assert sum(found["n_linked"].to_pylist()) > 100


def test_quotations_across_blocks(spark):
    rows = [(1, t, "user", f"line {t}\n> line {t - 300}" if t % 7 == 0 else f"line {t}") for t in range(0, 1200, 1)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.turn: r for r in quotations.link_quotations(spark, docs).collect()}
    depth = {}
    for t in range(1200):
        reply = None if t == 0 else t - 300 if t % 7 == 0 and t >= 300 else t - 1
        depth[t] = 0 if reply is None else depth[reply] + 1
        assert (found[t].reply_to, found[t].depth, found[t].thread) == (reply, depth[t], 0)


# WARC


def _pages(spark):
    whole = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    long = "é" * 700
    html = [
        "short", "short", None, "", long, long, "x" * 5000, f"a{whole}b{whole}", whole, "WARC/1.1\r\n" * 9, "WARC/1.1\r\nContent-Length: 10\r\n\r\n",
        "y" * 999, "y" * 999, "z" * 1000, "z" * 1000, "\r\n\r\n" * 40 + "WARC/1.1", f"{whole * 9}{long}", "Content-Length: 5\r\n\r\n",
    ]
    rows = [(i, None if i % 3 else f"http://h/{i}\r\nX: y", text) for i, text in enumerate(html)]
    rows += [(100, "u", f"page {i} " * 90) for i in range(2)] + [(None, "u", long), (14, "again", "z" * 1000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kind", F.lit(1))


def _expected(rows, least=1000):
    newest = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= least and r.page_id is not None:
            newest[body] = max(newest.get(body, r.page_id), r.page_id)
    out = []
    for r in rows:
        body = (r.html or "").encode()
        copies = sum((x.html or "").encode() == body for x in rows)
        first = newest.get(body) if copies > 1 else None
        revisit = first is not None and r.page_id != first
        kind = "revisit" if revisit else "response"
        out.append((r.page_id, kind, first if revisit else None, len(body), hashlib.sha1(body).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", ["1500", "100000"])
def test_warc_round_trip(spark, split):
    pages = _pages(spark)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = warc.round_trip(spark, pages.coalesce(2)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, found), key=repr) == _expected(pages.collect())


def test_warc_of_nothing(spark):
    assert warc.round_trip(spark, _pages(spark).limit(0)).count() == 0


# pipeline


def test_pipeline(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    columns, kept = docs.columns, [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        frame = docs.toPandas()
        docs = spark.createDataFrame(frame, docs.schema)
        kept.append(frame)
    raw, good, ruled, single, clean = kept
    lost = set(raw.doc_id) - set(good.doc_id)
    assert sum(quality.get(i) == 0 for i in lost) >= 0.85 * sum(q == 0 for q in quality.values())
    assert sum(quality.get(i) == 1 for i in lost) <= 0.02 * len(quality)
    words = dict(zip(good.doc_id, (len(t.split()) for t in good.text), strict=True))
    assert set(ruled.doc_id) <= {i for i, n in words.items() if n >= 50}
    assert sum(n >= 50 for n in words.values()) - len(ruled) < 0.02 * len(words)
    expected = _brute_components(list(zip(ruled.doc_id, ruled.text, strict=True)), 5, 80)
    assert set(single.doc_id) == set(expected.values())
    assert set(clean.doc_id) == set(single.doc_id)
    assert not clean.text.str.contains("@mail").any() and single.text.str.contains("@mail").any()
    assert (clean.n_chars == clean.text.str.len()).all()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).toPandas()
    assert set(pieces.doc_id) == set(clean.doc_id)
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def _ruled(rows):
    """Id and remaining text of the (id, text, host) that the rules stage keeps, under its own limits."""
    normal = lambda line: " ".join(line.lower().split())
    bodies = {}
    for _, text, host in rows:
        bodies.setdefault(host, set()).add(tuple(normal(line) for line in text.split("\n") if line.split()))
    frequent = set()
    for host, own in bodies.items():
        holders = Counter(line for body in own for line in set(body))
        frequent |= {(host, line) for line, n in holders.items() if n >= 5 and n * 100 > 5 * len(own)}
    kept = {}
    for i, text, host in rows:
        words = text.split()
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(grams)
        inside = {k + d for k, gram in enumerate(grams) if times[gram] > 1 for d in range(3)}
        lines = text.split("\n")
        gone = sum(len(line.split()) for line in lines if (host, normal(line)) in frequent)
        left = len(words) - gone
        if left >= 50 and 2 * len(inside) <= len(words) and left * 100 >= 30 * len(words):
            kept[i] = "\n".join(line for line in lines if (host, normal(line)) not in frequent)
    return kept, frequent


def _masked(text, spans):
    out, at = "", 0
    for start, kind, end in spans:
        if start >= at:
            out += f"{text[at:start]}<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_pipeline_stages_equal_plain_python(spark):
    chance = random.Random(9)
    own = lambda n: " ".join(f"w{chance.randrange(10**6)}" for _ in range(n))
    footer, notice = "Shared  FOOTER of hot", " ".join(f"notice{i}" for i in range(70))
    texts = [f"{own(60)}\n\n{footer if i % 2 else footer.lower()}" for i in range(130)]
    texts += [f"{notice}\n{own(n)}" for n in range(5, 115)]  # depleted below 50 words of their own
    texts += [own(49), f"{own(9)} " * 8, own(3000)] + [f"{own(55)} {i}\nonly in copies" for i in (1,)] * 120
    rows = [(i, text, "hot") for i, text in enumerate(texts)]
    rows += [(1000 + i, f"{own(60)}\n{footer}", "cold") for i in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda rows: spark.createDataFrame([(i, t, "en", h, len(t)) for i, t, h in rows], schema)
    expected, frequent = _ruled(rows)
    footer = footer.lower().replace("  ", " ")
    assert frequent == {("hot", footer), ("hot", notice), ("cold", footer)}
    assert 0 < sum(i not in expected for i in range(130, 240)) < 110 and not {240, 241} & expected.keys()
    ruled = corpus_pipeline.rules(spark, table(rows), SMALL)
    assert {r.doc_id: r.text for r in ruled.collect()} == expected

    unmatched = "(555) 123-4567"
    texts = [f"{own(9)} so please dial +1 555 010 {1000 + i} today" for i in range(20)]
    texts += [f"mail a.b{i}@mail.example from 10.0.0.{i * 10} or 4111 1111 1111 1111 é {own(20)}" for i in range(20)]
    texts += [f"so please dial {unmatched} today", "in 1999 nothing", own(3000)]
    expected = {}
    for i, text in enumerate(texts):
        spans = [(start, ("email", "ip", "card", "phone")[place], end) for start, place, end in _brute_pii(text)]
        at = text.find(unmatched)
        expected[i] = _masked(text, spans if at < 0 else [*spans, (at, "phone_context", at + len(unmatched))])
    assert {f"<{k}>" for k in ("EMAIL", "IP", "CARD", "PHONE", "PHONE_CONTEXT")} <= set(" ".join(expected.values()).split())
    clean = corpus_pipeline.personal_data(spark, table([(i, t, "hot") for i, t in enumerate(texts)]), SMALL)
    clean = spark.createDataFrame(clean.collect(), schema)
    assert {r.doc_id: r.text for r in clean.collect()} == expected

    _packed_right(corpus_pipeline.pack(spark, clean, SMALL).collect(), expected)


def test_pipeline_on_odd_rows(spark):
    clashing = ("score", "kept", "a.b", "id", "doc", "row", "found", "spans", "place", "__place", "__row", "__text", "__doc")
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += ", ".join(f"`{name}` string" for name in clashing)
    first = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "word " * 200, "en", "s", 1000)]
    rows = [(*row, *("x" if i else None for _ in clashing)) for i, row in enumerate(first)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, SMALL)
            assert out.count() <= 3 and (name == "packing" or out.columns == docs.columns)


SCHEMA_OF_DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_give_back_their_tables(spark):
    from tallyhouse.llm import scratch

    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    docs = spark.createDataFrame([(i, f"{text(i)}\nfooter of all", "en", "s", 1) for i in range(9)], SCHEMA_OF_DOCUMENTS)
    before = set(scratch._written)
    ruled = corpus_pipeline.rules(spark, docs, SMALL)
    first = set(scratch._written) - before
    stored = scratch.land(spark, ruled, "test")
    clean = corpus_pipeline.personal_data(spark, stored, SMALL)
    assert first and not first & set(scratch._written)
    assert {r.doc_id: r.text for r in clean.collect()} == {i: text(i) for i in range(9)}
    # What an unwritten input still reads stays.
    chained = corpus_pipeline.personal_data(spark, corpus_pipeline.rules(spark, docs, SMALL), SMALL)
    assert chained.count() == 9
    scratch.release(spark, stored)


def test_kept_texts_travel_once(spark):
    """The pipeline keeps the texts; with a second copy for the score, a batch takes twice the memory."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Some words, and more.", "", None, "x" * 50] * 600)], "doc_id long, text string")
    weights = np.linspace(-1, 1, (1 << 18) + 1, dtype=np.float32)
    kept = quality_classifier.score(spark, docs, weights, keep=("text",))
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert plan.count("text#") and "coalesce(text" not in plan
    expected = {row.doc_id: row.score for row in quality_classifier.score(spark, docs, weights).collect()}
    rows = kept.collect()
    assert len(rows) == 2400 and {row.doc_id: row.score for row in rows} == expected
    assert {row.doc_id: row.text for row in rows} == {row.doc_id: row.text for row in docs.collect()}
