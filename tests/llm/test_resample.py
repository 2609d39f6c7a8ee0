"""Resampling against plain Python, and ranks of equal and skewed scores."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfwatch.llm import resample as R
from shelfwatch.llm import text as tx
from shelfwatch.llm.storage import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)


def cells(text, buckets=10_000):
    return [zlib.crc32(f.encode()) % buckets for f in features(text)[0]]


def brute(docs, target, percent=25, least=20, seed=7):
    s, t = Counter(c for _, x in docs for c in cells(x)), Counter(c for x in target for c in cells(x))
    total, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (total + 10000) / ((s[k] + 1) * (wanted + 10000)))) for k in range(10000)]
    rows = []
    for i, x in docs:
        f = cells(x)
        weight = sum(gain[c] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), features(x)[1]])
    best = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(best[: len(best) * percent // 100])]
    return drawn, sorted((tuple(r[:4]) for r in rows), key=str)


ODD = ["", "x" * 500, "Ä Ö É straße 漢字 ﬁ", "a" * 33 + " " + "b" * 32 + " " + "c" * 40, "1 22 a-b_c\x7fd", "\t \n", "ab\x00cd", "😀 😀 😀"]


def test_checksums_of_words_and_pairs():
    column = pa.array([*ODD, None, " ".join(ODD * 3)], pa.string())
    for at, to, raw, bounds in tx.slices(column):
        row, bucket, words = R.features(raw, bounds, 2**32)
        for k in range(at, to):
            text = column[k].as_py()
            found, n = features(text)
            assert sorted(bucket[row == k - at].tolist()) == sorted(zlib.crc32(f.encode()) for f in found), text
            assert words[k - at] == n


def test_draw_equals_brute_force(spark, prose, rng):
    docs = [(k, prose(rng.randint(0, 60))) for k in range(200)]
    docs += [(1000 + k, docs[3][1]) for k in range(20)] + [(5, docs[9][1]), (5, docs[9][1]), (None, prose(30)), (None, prose(3)), (700, None)]
    docs += [(2000 + k, t) for k, t in enumerate(ODD)]
    target = [prose(20) for _ in range(10)] + [None, ""]
    frame = spark.createDataFrame([(i, t, 0, "y") for i, t in docs], "doc_id long, text string, score int, rank string").repartition(9)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = R.resample(spark, frame, goal).collect()
    drawn, everything = brute(docs, target)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in found), key=str) == everything
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found if r["rank"] is not None), key=lambda r: r[4]) == drawn


def test_nothing_to_draw_and_no_target(spark, prose):
    empty = spark.createDataFrame([], "doc_id string, text string")
    one = spark.createDataFrame([("a", prose(30)), ("b", "short")], "doc_id string, text string")
    assert R.resample(spark, empty, one).count() == 0
    found = {r.doc_id: r for r in R.resample(spark, one, empty, percent=100).collect()}
    assert (found["a"]["rank"], found["b"]["rank"]) == (1, None)


def test_equal_rows_fill_segments_evenly(spark):
    """Half of the rows are one row: they are split between segments, and every rank is given once."""
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50).alias("score"))
    scratch = Scratch(spark, "test")
    ranked = R.regular_ranks(spark, scratch, rows.repartition(6), segments=10).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 4001))
    keys = [(-r.score, r.id) for r in sorted(ranked, key=lambda r: r["rank"])]
    assert keys == sorted(keys)
    merged = spark.read.parquet(f"{scratch.folder}/*-segments").groupBy("segment").count().collect()
    assert max(r["count"] for r in merged) <= 2 * 4000 / 10 and np.sum([r["count"] for r in merged]) == 4000
