"""Encoding with spans against the library, over plain and normalising models."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shelfwatch.llm import pieces, queries
from shelfwatch.llm.pieces import Model, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "ab cde  fgh  \n\t▁ .,0123 é漢字😀\x00ﬁ①Ａ　ß<>xｶﾞ½ﷺé"


def with_rules(rule, folder):
    """The model with the library's own rules of one name as its normalisation."""
    with open(PATH, "rb") as file:
        kept = [whole for field, _, whole in pieces._fields(file.read()) if field != 3]
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    path = folder / f"{rule}.model"
    path.write_bytes(b"".join(kept) + b"\x1a" + pieces._encoded(len(spec)) + spec)
    return str(path)


def wanted(library, text):
    found = library.encode(text, return_type="proto").pieces
    return [(p.id, p.begin, p.end) for p in found]


def texts(count, seed):
    rng = random.Random(seed)
    out = ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(count)]
    return [*out, "", " ", "   ", "\n", "x" * 5000, "漢" * 3000, "a " * 4000, "▁▁ ▁"]


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nfkc_cf", "identity"])
def test_ids_and_spans_equal_the_library(tmp_path, rule):
    path = with_rules(rule, tmp_path) if rule else PATH
    model, library = Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    many = texts(1500, 5)
    ids, starts, ends, bounds = model.pieces(many)
    for k, text in enumerate(many):
        part = slice(bounds[k], bounds[k + 1])
        assert list(zip(ids[part].tolist(), starts[part].tolist(), ends[part].tolist())) == wanted(library, text), repr(text)


def test_longest_key_wins():
    compiled = sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_normalizer_spec()
    rules = pieces.CharacterMap(dict((f, v) for f, v, _ in pieces._fields(compiled))[2])
    raw = "ｶﾞ é ｶ".encode()
    out, source = rules.replace(raw)
    assert out.decode() == "ガ é カ"
    assert np.flatnonzero(np.diff(source, prepend=-1)).tolist() == [0, 3, 4, 6, 7]
    assert source.tolist() == [0, 0, 0, 6, 7, 7, 10, 11, 11, 11]


def test_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op11_pieces(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r.covered == r.last_end == len(docs[r.doc_id].encode())


def test_odd_rows(spark):
    schema = "doc_id string, text string, ids int, starts string, id int"
    assert encode(spark.createDataFrame([], schema), PATH).count() == 0
    rows = [(None, "ab", 1, "x", 2), ("a", None, 1, None, 2), ("a", "", 1, "x", 2), ("a", "ab", None, "x", None)]
    found = sorted(encode(spark.createDataFrame(rows, schema), PATH).collect(), key=lambda r: (r.doc_id or "", len(r.ids)))
    assert [(r.doc_id, len(r.ids), r.decoded) for r in found] == [(None, 1, "ab"), ("a", 0, ""), ("a", 0, ""), ("a", 1, "ab")]
    assert (found[-1].starts, found[-1].ends) == ([0], [2])
