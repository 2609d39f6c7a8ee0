"""Disguised personal data planted in prose: what the trees add, and redaction of odd rows."""

from __future__ import annotations

import random

import pytest

from shelfwatch.llm import pii
from shelfwatch.session import configure

HIDDEN = [
    "john dot doe (at) example dot com", "mary[at]mail[dot]org", "ann.lee (at) post.example.net", "212-555-0142", "(415) 555-2671", "303.555.0188",
    "10[.]1[.]2[.]3", "172(.)16(.)254(.)1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "4111.1111.1111.1111", "5500/0000/0000/0004",
]
HARMLESS = ["we met at noon", "order 212-555-0142", "4111.1111.1111.1112", "look @ this one.", "version 10.2.3", "12:30:45"]


@pytest.fixture(scope="module")
def judge(spark):
    return pii.learn(configure(spark).read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text"))


def test_planted_data_are_found(spark, judge, prose):
    rng = random.Random(2)
    rows, wanted = [], {}
    for k in range(220):
        hidden = HIDDEN[k % len(HIDDEN)]
        text = f"{prose(rng.randint(2, 30))} {hidden} {prose(3)} {rng.choice(HARMLESS)} {prose(2)}"
        at = text.index(hidden)
        rows.append((k, text))
        wanted[k] = (at, at + len(hidden))
    found = pii.detect(spark.createDataFrame(rows, "id int, text string"), "text", judge).collect()
    right = sum(any(s.start <= wanted[r.id][0] + 4 and s.end >= wanted[r.id][1] for s in r.spans) for r in found)
    total = sum(len(r.spans) for r in found)
    missed = sorted({HIDDEN[r.id % len(HIDDEN)] for r in found if not any(s.start <= wanted[r.id][0] + 4 and s.end >= wanted[r.id][1] for s in r.spans)})
    assert right >= 0.9 * len(rows) and right >= 0.9 * total, missed
    assert total > sum(len(r.base_spans) for r in found)


def test_redaction_keeps_other_columns(spark, judge):
    frame = spark.createDataFrame([(1, "a@b.de and 10.0.0.1", "p", "s", 3), (1, None, None, "s", 4), (None, "", "p", None, 5)], "id int, text string, parts string, spans string, base int")
    got = pii.redact(frame, "text", judge)
    assert got.columns == frame.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [(1, "[EMAIL] and [IP]", "p", "s", 3), (1, None, None, "s", 4), (None, "", "p", None, 5)])
    )


def test_span_filter_equals_every_pair(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(40):
        base = [(0, a, a + rng.randint(1, 30)) for a in (rng.randint(0, 200) for _ in range(rng.randint(0, 8)))]
        wide = [(1, a, a + rng.randint(1, 9)) for a in (rng.randint(0, 200) for _ in range(rng.randint(0, 90)))]
        rows.append((base, wide))
    span = "array<struct<kind:int,start:int,end:int>>"
    found = spark.createDataFrame(rows, f"base {span}, wide {span}").select("base", "wide", pii._free("base", "wide").alias("free")).collect()
    for r in found:
        want = [w for w in r.wide if not any(b.start < w.end and w.start < b.end for b in r.base)]
        assert sorted(map(tuple, r.free)) == sorted(map(tuple, want))


def test_every_span_of_every_row_is_learned_from(spark):
    docs = configure(spark).range(6000).selectExpr("id", "concat('write to user', id, '@mail', id % 7, '.org today, or 212-555-0142') AS text")
    examples = pii._examples(docs, "text")
    right, wrong = (examples.where(f"kind = {k}").agg({"n": "sum"}).first()[0] for k in (0, 3))
    # Four disguises of each address; the number of each row is proposed and is none of the base.
    assert examples.where("kind = 0 AND label = 1").agg({"n": "sum"}).first()[0] == 4 * 6000
    assert right >= 4 * 6000 and wrong >= 6000
    assert examples.count() < 2000
