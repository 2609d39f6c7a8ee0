"""Near copies, embeddings and benchmark leaks against brute force."""

from __future__ import annotations

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import covertree, decontaminate
from shelfwatch.llm.components import components
from shelfwatch.llm.jaccard import jaccard_components

from .test_text import WORD, lowered


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def shingles(text, k):
    words = WORD.findall(lowered(text))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 140)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (200, 201), (201, 200)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(spark, links).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark, links.where("false")).count() == 0


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(spark, prose, rng, words, percent):
    texts = [prose(rng.randint(1, 60)) for _ in range(25)]
    line = prose(12)
    for base in texts[:8]:
        for edits in (0, 1, 1, 2, 4):
            w = base.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = "new"
            texts.append(" ".join(w).upper() if edits == 1 else " ".join(w))
    texts += [f"{prose(3)} {line}" for _ in range(12)] + [None, "", "  ", "one", "One", "one two"]
    sets = [shingles(t, words) for t in texts]
    links = [
        (a, b) for b in range(len(texts)) for a in range(b)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = roots(len(texts), links)
    docs = spark.createDataFrame([(k, t, "x", -1) for k, t in enumerate(texts)], "doc_id long, text string, vertex string, n int")
    found = jaccard_components(spark, docs, words=words, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {k: (len(sets[k]), want[k]) for k in range(len(texts))}


def test_jaccard_null_and_repeated_ids(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (5, "other words here now"), (None, "a b c d e"), (None, "lone text of its own"), (9, None)]
    found = jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == [
        ("5", 1, "5"), ("5", 2, "5"), ("5", 2, "5"), ("9", 0, "9"), ("None", 2, "5"), ("None", 2, "None"),
    ]
    assert jaccard_components(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("block", [16, 4096])
def test_embedding_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 8))
    vectors = [(b + rng.normal(scale=s, size=8)).astype(np.float32).tolist() for b in base for s in (0, 0.1, 0.3, 0.5)]
    vectors += [vectors[0]] * 5 + [[2 * x for x in vectors[4]], [0.0] * 8, [-0.0] * 8, [float("nan")] * 8, [1.0] * 7 + [float("inf")], [], None,
                [None] + [1.0] * 7, [1.0, 0.0], [1.0, 0.01], [1e-30, 0.0], [3e38, 0.0]]
    n = len(vectors)

    def cosine(a, b):
        if not a or not b or len(a) != len(b) or None in a or None in b or not np.isfinite([*a, *b]).all():
            return -2
        x, y = math.hypot(*a), math.hypot(*b)
        return math.fsum((p / x) * (q / y) for p, q in zip(a, b)) if x and y else -2

    links = [(a, b) for b in range(n) for a in range(b) if cosine(vectors[a], vectors[b]) >= 0.9]
    want, degree = roots(n, links), [sum(k in p for p in links) for k in range(n)]
    frame = spark.createDataFrame([(k, v, 1, "x") for k, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, uid string")
    found = {r["vec_id"]: r for r in covertree.embedding_links(spark, frame, block=block).collect()}
    assert {k: (r["n_links"], r["component_id"], r["kept"]) for k, r in found.items()} == {k: (degree[k], want[k], want[k] == k) for k in range(n)}


def test_embedding_links_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert covertree.embedding_links(spark, empty).count() == 0
    lone = spark.createDataFrame([(None, [1.0]), (4, [1.0]), (4, None)], "vec_id long, embedding array<float>")
    rows = covertree.embedding_links(spark, lone).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in rows) == [
        ("4", 0, "4", True), ("4", 1, "4", True), ("None", 1, "4", False),
    ]


def test_pairs_of_blocks_are_compared_in_rounds_without_a_shuffle(spark, monkeypatch):
    from shelfwatch.llm.storage import Scratch

    monkeypatch.setattr(covertree, "GROUP", 20_000)
    monkeypatch.setattr(covertree, "ROUNDS", 2)
    rng = np.random.default_rng(5)
    vectors = np.repeat(rng.normal(size=(60, 8)), 5, axis=0) + rng.normal(scale=0.15, size=(300, 8))
    vectors[::2] = vectors[::2].astype(np.float32)  # others need double precision
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    want = roots(300, np.argwhere(np.triu(linked, 1)).tolist())
    plans = {}
    store = Scratch.store

    def watched(self, df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(self, df, name)

    monkeypatch.setattr(Scratch, "store", watched)
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in covertree.embedding_links(spark, frame, block=16).collect()}
    assert {k: (r["n_links"], r["component_id"]) for k, r in found.items()} == {k: (linked[k].sum() - 1, want[k]) for k in range(300)}
    assert len(plans["found"]) > 2 and not any("Repartition" in p or "Join" in p for p in plans["found"])


def test_each_pair_of_blocks_has_one_owner():
    for n in range(1, 10):
        assert all(covertree._owned(i, j, n) != covertree._owned(j, i, n) for i in range(n) for j in range(i))
        assert all(covertree._owned(i, i, n) for i in range(n))


def test_vectors_are_kept_without_loss():
    import pyarrow as pa

    vectors = [[1.5, -0.0], [0.1, 2.0], [1e300, 1.0], [1e-45, 0.0], [0.0], [], None, [None, 1.0], [float("nan")], [float("inf"), 1.0]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(vectors, pa.list_(pa.float64()))], names=["id", "vector"])
    out = next(covertree._encode(iter([batch])))
    packed = out.column("packed").to_pylist()
    assert [p and (p[-1], covertree._decode([p], 2).tolist()[0]) for p in packed] == [
        (4, [1.5, 0.0]), (8, [0.1, 2.0]), (8, [1e300, 1.0]), (8, [1e-45, 0.0]), *[None] * 6,
    ]
    assert covertree._decode(packed[:2], 2).tolist() == [[1.5, 0.0], [0.1, 2.0]]


def plain_alignment(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment_scores():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 15))] for _ in "ab")
        assert decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == plain_alignment(a, b)


@pytest.mark.parametrize("block_words", [40, 1 << 20])
def test_leaks_equal_brute_force(spark, prose, rng, block_words):
    items = [prose(rng.randint(12, 40)) for _ in range(8)] + ["two words", None, ""]
    docs = [prose(80) for _ in range(10)]
    for item in items[:8]:
        w = item.split()
        edited = [x if k % 7 else "changed" for k, x in enumerate(w)]
        docs += [f"{prose(30)} {item.upper()}! {prose(30)}", f"{prose(500)} {' '.join(edited)} {prose(5)}", " ".join(w[: len(w) // 4])]
    docs += [None, "", "two words", items[0]]
    words = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    want = set()
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            n, score = len(words(item)), plain_alignment(words(item), words(text)) if len(words(item)) >= 3 and words(text) else 0
            if n >= 3 and (score >= 0.5 * n and score >= 6 or score >= n):
                want.add((d, i, score))
    frame = spark.createDataFrame([(k, t, 0) for k, t in enumerate(docs)], "doc_id long, text string, score int")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.find_leaks(spark, frame, bench, block_words=block_words).collect()
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in found} == want
    leaked = {d for d, _, _ in want}
    kept = decontaminate.drop_leaks(spark, frame, bench, block_words=block_words)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(docs))) - leaked
    assert decontaminate.find_leaks(spark, frame, bench.where("false")).count() == 0
    assert decontaminate.find_leaks(spark, frame.where("false"), bench).count() == 0
    assert decontaminate.drop_leaks(spark, frame.withColumn("doc_id", F.lit(None).cast("long")), bench).count() == len(docs) - len(leaked)


def test_hot_vertices_are_dealt_out_without_loss(spark, prose, rng, monkeypatch):
    """One text and many edits of it: a leader of more pairs than a task takes."""
    from shelfwatch.llm import jaccard

    monkeypatch.setattr(jaccard, "DEALT", 3)
    base = prose(60).split()
    texts = [" ".join(base)] * 3
    for k in range(40):
        w = list(base)
        w[k] = f"edit{k}"
        texts.append(" ".join(w))
    sets = [shingles(t, 4) for t in texts]
    links = [(a, b) for b in range(len(texts)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(len(texts), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = jaccard_components(spark, docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(want))


@pytest.mark.parametrize("spread", [0.05, 5.0])
def test_traversal_costs_no_more_than_a_few_products(spread):
    """Blocks with and without clusters: all links, at the price of comparing all points a few times."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(20, 32))
    one, two = (np.repeat(base, 60, axis=0) + rng.normal(scale=spread, size=(1200, 32)) for _ in "ab")
    a = covertree.build(np.arange(1200), np.ones(1200, np.int64), one)
    b = covertree.build(np.arange(1200, 2400), np.full(1200, 3), two)
    began = time.process_time()
    for _ in range(10):
        linked = covertree._unit(one) @ covertree._unit(two).T >= 0.9
    dense = (time.process_time() - began) / 10
    began = time.process_time()
    uids, links, _ = covertree.traverse(a, b, 0.9)
    took = time.process_time() - began
    want = np.r_[3 * linked.sum(axis=1), linked.sum(axis=0)]
    assert dict(zip(uids.tolist(), links.tolist(), strict=True)) == {k: n for k, n in enumerate(want.tolist()) if n}
    if spread > 1:
        assert took < 20 * dense + 0.1


def test_checked_pairs_send_only_marks_of_sets_that_differ(spark, prose, monkeypatch):
    """Pairs whose marks already tell that they don't link never get their whole sets read."""
    from shelfwatch.llm import jaccard
    from shelfwatch.llm.storage import Scratch

    texts = [prose(60) for _ in range(6)]
    texts[1] = texts[0] + " more"
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    common = spark.sparkContext.broadcast(jaccard._commonness(docs, 4))
    rows = jaccard._features(docs, "bigint", 4, 85, common).select("vertex", "id").collect()
    vertex = {r["id"]: r["vertex"] for r in rows}
    pairs = spark.createDataFrame([(vertex[a], vertex[b]) for b in range(6) for a in range(b)], "a long, b long")
    owners = spark.createDataFrame([(v, k) for k, v in vertex.items()], "vertex long, id long")
    kept = {}
    store = Scratch.store

    def watched(self, df, name):
        out = store(self, df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "store", watched)
    found = jaccard._checked(Scratch(spark, "checked"), pairs, docs, owners, 4, 85, common).collect()
    assert [(r["a"], r["b"]) for r in found] == [(vertex[0], vertex[1])]
    assert kept["marks"] == 6 and kept["open"] == 1 and kept["sets"] < 6
