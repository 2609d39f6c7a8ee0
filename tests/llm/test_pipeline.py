"""The pipeline's stages one by one against plain Python, and run() against the chain of them."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shelfwatch.llm.decontaminate import find_leaks
from shelfwatch.llm.storage import Scratch
from shelfwatch.session import configure

from .test_contracts import _KINDS, _kept
from .test_pairs import roots, shingles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage gets and gives."""
    configure(spark)
    scratch, out = Scratch(spark, "stages"), []
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        done = scratch.store(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        out.append((docs, done))
        docs = done
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_toxic_documents_go(spark, stages):
    before, after = map(by_id, stages[0])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = before.keys() - after.keys()
    assert after.keys() <= before.keys() and stages[0][1].columns == stages[0][0].columns
    assert sum(labels.get(k) == 0 for k in gone) <= 0.02 * len(before)
    toxic = [k for k, v in labels.items() if v == 1 and k in before]
    assert sum(k in gone for k in toxic) >= 0.6 * len(toxic)


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = map(by_id, stages[1])
    ids = sorted(before)
    sets = [shingles(before[k].text or "", 5) for k in ids]
    links = [
        (a, b) for b in range(len(ids)) for a in range(b) if sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    ]
    root = roots(len(ids), links)
    assert after.keys() == {k for n, k in enumerate(ids) if root[n] == n}


def test_contaminated_documents_go(spark, stages):
    docs = stages[2][0]
    before, after = map(by_id, stages[2])
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    plain = {k for k, r in before.items() if any(i.text and i.text in (r.text or "") for i in items.collect())}
    leaked = {r.doc_id for r in find_leaks(spark, docs, items).collect()}
    assert plain <= leaked and after.keys() == before.keys() - leaked


def test_personal_data_are_replaced(stages):
    before, after = map(by_id, stages[3])
    assert before.keys() == after.keys()
    for k, r in after.items():
        found = [m[0] for kind, p in _KINDS.items() for m in re.finditer(p, r.text or "") if _kept(kind, m[0])]
        assert not found and r.n_chars == len(r.text or "")
        if not any(_kept(kind, m[0]) for kind, p in _KINDS.items() for m in re.finditer(p, before[k].text or "")):
            assert r.text == before[k].text or "[" in r.text


def test_packed_ids_are_the_texts(stages):
    docs = by_id(stages[4][0])
    pieces: dict = {}
    for r in stages[4][1].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert pieces.keys() == docs.keys()
    for k, held in pieces.items():
        assert [i for _, ids in sorted(held) for i in ids] == [*coder.encode(docs[k].text or "", add_special_tokens=False).ids, 1]


def test_run_is_the_chain(spark, stages):
    shape = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert {x[0] for x in shape(corpus_pipeline.run(spark, FOLDER))} == {x[0] for x in shape(stages[4][1])}


def test_toxic_stage_keeps_clashing_columns(spark):
    rows = [(1, "good words here", 0.25, 7, "x"), (None, None, None, None, None), (3, "", 0.5, 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted int, row string")
    kept = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(rows)


def test_toxic_stage_sends_texts_to_python_once(spark):
    docs = spark.createDataFrame([(1, "good words here", "x")], "doc_id long, text string, row string")
    kept = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert [c.split("#")[0] for c in re.search(r"MapInArrow score\((.*?)\)", plan)[1].split(", ")] == ["doc_id", "text", "kept2"]
