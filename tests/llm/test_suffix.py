"""The suffix tree's scores against plain Python."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import suffixlm
from shelfwatch.llm import text as tx
from shelfwatch.llm.counters import has_bit

END = None
CONTEXT, FOLLOWER, DEPTH = 6, 2, 4


def texts() -> list[str]:
    """Phrases that depend on up to four words before, with noise."""
    draw = random.Random(5)
    phrases = [[draw.choice("abcdefgh") + str(k) for k in range(draw.randint(2, 7))] for _ in range(12)]
    out = []
    for _ in range(150):
        words = []
        for _ in range(draw.randint(0, 9)):
            words += draw.choice(phrases) if draw.random() < 0.8 else [draw.choice("xyz"), draw.choice("xyz")]
        out.append(" ".join(words))
    for _ in range(40):
        chain = [draw.choice("ST") for _ in range(4)]
        while len(chain) < 100:
            # Each of the last four words tells something.
            chain.append("S" if draw.random() < 0.5 + 0.11 * sum(1 if w == "S" else -1 for w in chain[-4:]) else "T")
        out.append(" ".join(chain))
    return [*out, "A0 a0\tnew", "x " * 700]


def brute(train: list[list], test: list[list]) -> list[float]:
    """Log10 probabilities under the tree that the training sequences give."""
    counts = Counter(tuple(t[i : i + k]) for t in train for k in range(1, DEPTH + 2) for i in range(len(t) - k + 1))
    unigrams = {g[0]: c for g, c in counts.items() if len(g) == 1}
    total, size = sum(unigrams.values()), len(unigrams)

    def alone(word) -> float:
        return (unigrams.get(word, 0) + 1) / (total + size + 1)

    kept: dict[tuple, tuple[dict, float]] = {}

    def predict(context: tuple, word) -> float:
        """By the longest kept suffix of the context."""
        while context not in kept:
            if not context:
                return alone(word)
            context = context[1:]
        shares, spare = kept[context]
        return shares.get(word, 0.0) + spare * predict(context[1:], word)

    followers = defaultdict(dict)
    for gram, c in counts.items():
        if len(gram) > 1 and c >= 2 and unigrams[gram[-1]] >= FOLLOWER:
            followers[gram[:-1]][gram[-1]] = c
    for depth in range(1, DEPTH + 1):
        for context, found in list(followers.items()):
            whole = counts[context]
            if len(context) != depth or whole < CONTEXT or END in context or depth > 1 and context[1:] not in kept:
                continue
            won = sum(c * math.log(c / whole / predict(context[1:], w)) for w, c in found.items())
            if won > 0.5 * len(found) * math.log(whole):
                shares = {w: (c - suffixlm.DISCOUNT) / whole for w, c in found.items()}
                kept[context] = (shares, 1 - sum(shares.values()))
    assert any(len(c) == DEPTH for c in kept)
    return [sum(math.log10(predict(tuple(t[max(0, i - DEPTH) : i]), w)) for i, w in enumerate(t)) for t in test]


@pytest.mark.parametrize(("head", "chunk"), [(1 << 20, 1 << 20), (20, 100)])
def test_scores_equal_brute_force(spark, monkeypatch, head, chunk):
    monkeypatch.setattr(suffixlm, "CONTEXT_COUNT", CONTEXT)
    monkeypatch.setattr(suffixlm, "FOLLOWER_COUNT", FOLLOWER)
    monkeypatch.setattr(suffixlm, "HEAD", head)
    monkeypatch.setattr(suffixlm, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(suffixlm, "LOOK_UP_TOKENS", chunk)
    monkeypatch.setattr(suffixlm, "BUCKET_BYTES", chunk * 10)
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in suffixlm.suffix_scores(spark, docs, F.expr("doc_id % 5 = 0"), depth=DEPTH).collect()}
    sequences = {k: [*t.lower().split(), END] for k, t in rows}
    train = [s for k, s in sequences.items() if k % 5]
    want = brute(train, list(sequences.values()))
    known = {w for s in train for w in s}
    assert len(found) == len(rows)
    for (k, s), score in zip(sequences.items(), want, strict=True):
        assert found[k].score == pytest.approx(score, rel=1e-9), k
        assert (found[k].n_tokens, found[k].n_known, found[k].held_out) == (len(s), sum(w in known for w in s), k % 5 == 0)
        assert found[k].train_tokens == sum(map(len, train))


def test_empty_table_and_no_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffixlm.suffix_scores(spark, empty, F.lit(False)).collect() == []
    docs = spark.createDataFrame([(1, None, "a"), (None, "b c", "b"), (1, "", None)], "doc_id bigint, text string, score string")
    assert {(r.n_tokens, r.score) for r in suffixlm.suffix_scores(spark, docs, F.lit(True)).collect()} == {(1, 0.0), (3, 0.0)}


def test_columns_are_made_for_countable_runs_only():
    """Few of a chunk's runs may count: the same ones as by all columns, in less memory."""
    draw = np.random.default_rng(4)
    tokens = tx.mix(draw.integers(0, 5000, 1 << 18).astype(np.uint64))
    rows = np.sort(draw.integers(0, 900, len(tokens)))

    class Table:
        def __init__(self, keys):
            marks = np.zeros(1 << 20, bool)
            marks[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.value = np.packbits(marks)

    tracemalloc.start()
    _, context, suffix, word, key = suffixlm._grams(tokens, rows, 4)
    whole = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    few = Table(context[::20]), Table(word[::9000]), Table(suffix[::2])
    keep = has_bit(few[0].value, context) & has_bit(few[1].value, word) & has_bit(few[2].value, suffix)
    tracemalloc.start()
    found = suffixlm._countable(tokens, rows, 4, *few)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for a, b in zip(found, (context, suffix, word, key), strict=True):
        assert a.tolist() == b[keep].tolist()
    assert keep.any() and peak < 0.7 * whole, (peak, whole)


def test_only_runs_beside_kept_contexts_are_looked_up():
    """Runs after a kept context and kept contexts are all met; few others are, and none across texts."""
    draw = np.random.default_rng(6)
    tokens = tx.mix(draw.zipf(1.3, 1 << 16).astype(np.uint64) % np.uint64(4000))
    rows = np.sort(draw.integers(0, 300, len(tokens)))
    marks, kept = np.zeros(1 << 22, bool), {1: np.unique(tokens)[::40]}

    def runs(size):
        at = np.flatnonzero(rows[: len(rows) - size + 1] == rows[size - 1 :])
        return at, suffixlm._join(*(tokens[at + k] for k in range(size)))

    for size in (2, 3):
        # A kept context's parent is kept.
        at, key = runs(size)
        parent = suffixlm._join(*(tokens[at + k] for k in range(1, size)))
        kept[size] = np.unique(key[np.isin(parent, kept[size - 1])])[::7]
    for keys in kept.values():
        marks[(keys & np.uint64(len(marks) - 1)).astype(np.int64)] = True

    class Table:
        value = np.packbits(marks)

    met = {size: (row, key) for size, row, key in suffixlm._candidates(tokens, rows, 4, Table)}
    assert met[1][1] is tokens
    for size in (2, 3, 4):
        at, key = runs(size)
        context = tokens[at] if size == 2 else suffixlm._join(*(tokens[at + k] for k in range(size - 1)))
        want = np.isin(context, kept[size - 1]) | np.isin(key, kept.get(size, kept[1][:0]))
        found = Counter(zip(met[size][0].tolist(), met[size][1].tolist(), strict=True))
        assert not Counter(zip(rows[at[want]].tolist(), key[want].tolist(), strict=True)) - found
        assert want.any() and sum(found.values()) < 0.7 * len(at)


def test_values_of_a_key_are_added():
    """A run that is a follower and a context has two rows in the model."""
    top = 2**64 - 1
    keys = np.array([7, top - 1, 7, 1 << 63, 7], np.uint64)
    numbers = suffixlm._Numbers(keys, np.array([2.0, 3, 2, 4, 2]), np.array([0.5, 1, 0.25, 2, 0]))
    wanted = np.array([top, 7, 0, 1 << 63, 8, top - 1, 7], np.uint64)
    here, place = numbers.find(wanted)
    assert here.tolist() == [False, True, False, True, False, True, True]
    assert numbers.value[place].tolist() == [0.75, 2, 1, 0.75] and numbers.base[place].tolist() == [2, 4, 3, 2]
    nothing = suffixlm._Numbers(keys[:0], np.zeros(0), np.zeros(0))
    assert not nothing.find(wanted)[0].any()


@pytest.mark.parametrize("size", [2, 3])
def test_runs_are_dealt_in_ranges(monkeypatch, size):
    """A chunk's runs and their numbers go to their buckets without sorted columns of the whole chunk."""

    class Every:
        value = np.full(1 << 17, 255, np.uint8)

    class Texts:
        made = None

        def mapInArrow(self, rows, schema):
            self.made = self.made or rows
            return self

        def repartitionById(self, *_):
            return self

    monkeypatch.setattr(suffixlm.F, "col", lambda name: name)
    draw = random.Random(8)
    words = [f"w{draw.randrange(1000)}" for _ in range(250_000)]
    column = pa.RecordBatch.from_arrays([pa.array([" ".join(words[k : k + 500]) for k in range(0, len(words), 500)])], names=["text"])
    texts, buckets = Texts(), 5
    suffixlm._gram_counts(texts, size, buckets * suffixlm.CHUNK_TOKENS // 2, Every, Every, None if size == 2 else Every)
    list(texts.made([column.slice(0, 10)]))
    tracemalloc.start()
    # What was yielded is let go, as in a task.
    rows = 0
    for batch in texts.made([column]):
        rows += batch.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows and peak < 110 * len(words), peak / len(words)
    found = Counter()
    for batch in texts.made([column]):
        for bucket, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            context, word, *_, n = suffixlm._unpacked(runs, *["<u8"] * size, "<u4")
            key = suffixlm._join(context, word)
            assert 0 <= bucket < buckets
            found.update(dict(zip(key.tolist(), n.tolist(), strict=True)))
    want = Counter()
    for _, _, tokens, row in suffixlm._tokens([column]):
        _, context, _, word, _ = suffixlm._grams(tokens, row, size)
        want.update(suffixlm._join(context, word).tolist())
    assert found == want


def test_batches_of_long_texts_are_small(spark):
    """Rows that wait for Python are bounded in bytes, not in number alone."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("0123456789"), 1000).alias("text"))
    found = [r.n for r in texts.mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) > 20_000_000 and max(found) < 5_000_000
