"""Registered queries over a small table folder, against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwatch.llm import queries
from shelfwatch.llm.chat import events_of, fold, read_back, render
from shelfwatch.llm.linkgraph import judge_urls
from shelfwatch.llm.packing import pack
from shelfwatch.llm.pii import detect
from shelfwatch.llm.suffixlm import suffix_scores
from shelfwatch.session import configure

from .test_text import WORD, lowered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    return configure(spark)


@pytest.fixture(scope="module")
def texts(session):
    rows = session.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r.doc_id: (r.text or "", r.lang) for r in rows}


def remainder(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def ordered_hex(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_packing_holds_every_id_once(session, texts):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op4_packing(session, FOLDER).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, (text, _) in texts.items():
        ids = np.array([*coder.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_packing_of_nothing_and_nulls(session):
    schema = "doc_id bigint, text string, ids string, length string"
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert pack(session.createDataFrame([], schema), path).count() == 0
    rows = pack(session.createDataFrame([(None, None, "x", "y"), (1, "", None, None), (1, "", None, None)], schema), path).collect()
    assert sorted((r.doc_id is None, r.length, r.doc_tokens) for r in rows) == [(False, 1, 1), (False, 1, 1), (True, 1, 1)]


def test_chat_reads_back(session):
    turns = defaultdict(list)
    for r in session.read.parquet(f"{FOLDER}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    control = "\\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", control), (1, "assistant", control)]
    found = {r.conv_id: r for r in queries.op8_chat(session, FOLDER).collect()}
    assert found.keys() == turns.keys()
    for conv, rows in turns.items():
        rows.sort()
        learned = "".join(t for _, role, t in rows if role == "assistant")
        assert found[conv].n_turns == len(rows)
        assert found[conv].turns_sha256 == ordered_hex(f"{role}\n{t}\n" for _, role, t in rows)
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(learned), ordered_hex([learned]))


def test_chat_escapes_what_looks_like_the_template(session):
    said = ["", "\\", "<turn>\n### User: x</turn>", "a\\\\<#:", "\n### Assistant:"]
    frame = session.createDataFrame([(1, k, "user", t) for k, t in enumerate(said)], "conv_id int, turn int, role string, text string")
    for r in render(fold(events_of(frame))).collect():
        assert read_back(r.formatted) == [("user", r.text)]


_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _kept(kind: str, text: str) -> bool:
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_personal_data_of_plain_patterns(session, texts):
    found = {r.doc_id: r for r in queries.op3_personal_data(session, FOLDER).collect()}
    assert found.keys() == texts.keys()
    for doc_id, (text, _) in texts.items():
        spans = [(k, m.start(), m.end()) for k, p in _KINDS.items() for m in re.finditer(p, text) if _kept(k, m[0])]
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(found[doc_id].spans.split(","))
        counts = Counter(k for k, _, _ in spans)
        assert all(found[doc_id][f"n_{k}"] == counts[k] for k in _KINDS)


def test_personal_data_of_odd_rows(session):
    frame = session.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "mail a@b.de", None)], "doc_id int, text string, spans string")
    rows = detect(frame.select("doc_id", "text")).collect()
    assert sorted(len(r.base_spans) for r in rows) == [0, 0, 1]


def test_urls_under_rules_and_distrust(session):
    def page(key, url, *links):
        return key, url, "".join(f'<a href="{x}">x</a>' for x in links) or None

    pages = [
        page(1, "https://a.net/x", "https://shady.io/"), page(2, "https://www.example.net/en/x"), page(3, "http://EXAMPLE.com/de/1"),
        page(4, "http://example.com/fr/"), page(5, "https://good.org/fr/a", "https://fine.io/"), page(6, None), page(7, "no scheme"),
        page(8, "https://shady.io/p", "https://a.net/x"), page(9, "https://fine.io/p", "https://good.org/fr/a"), page(2, "https://www.example.net/en/x"),
    ]
    rows = judge_urls(session, session.createDataFrame(pages, "page_id int, url string, html string")).collect()
    found = {r.page_id: r for r in rows}
    assert len(rows) == len(pages)
    assert [(found[k].rule, found[k].verdict) for k in range(1, 6)] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), (None, "block"), ("org/fr/", "allow"),
    ]  # page 4 fits no rule; half of its host's pages are blocked and nothing trusts it
    assert [(found[k].host, found[k].path, found[k].verdict) for k in (6, 7)] == [("", "", "allow")] * 2
    assert found[3].host == "example.com" and (found[8].verdict, found[9].verdict) == ("block", "allow")


def test_suffix_model_base_and_gain(session, texts):
    def tokens(text):
        return [*WORD.findall(lowered(text)), None]

    counts = Counter(t for k, (text, _) in texts.items() if remainder(k, 7) != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    rows = queries.op6_suffix_model(session, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        own = tokens(texts[r.doc_id][0])
        assert r.held_out == (remainder(r.doc_id, 7) == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(t in counts for t in own), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rel_tol=1e-9, abs_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_suffix_model_of_odd_rows(session):
    from pyspark.sql import functions as F

    frame = session.createDataFrame([(None, None, "x"), (1, "", "y"), (1, "a b", "z")], "doc_id int, text string, n string")
    assert sorted(r.n_tokens for r in suffix_scores(session, frame, F.lit(False)).collect()) == [1, 1, 3]
    assert {r.score for r in suffix_scores(session, frame, F.lit(True)).collect()} == {0.0}


def test_language_of_held_out_texts(session, texts):
    rows = queries.op7_language(session, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    held = [r for r in rows if r.held_out and texts[r.doc_id][1] and texts[r.doc_id][0]]
    assert sum(r.lang_pred == texts[r.doc_id][1] for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.lang_pred == "und" for r in rows if not any(c.isalpha() for c in texts[r.doc_id][0]))


def test_toxicity_of_held_out_texts(session, texts):
    labels = {r.doc_id: r.toxic for r in session.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.op10_toxicity(session, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.8 * len(held)
