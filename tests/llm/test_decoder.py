"""The deobfuscating decoder against every reading of short tokens; packing's cuts against every cut."""

from __future__ import annotations

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwatch.llm import packing
from shelfwatch.llm import text as tx
from shelfwatch.llm.toxicity import REPEAT, SIGN, SKIP, SKIP_SIGN, STANDS_FOR, Channel, Words, toxicity

LEXICON = "shit kill idiot ass hello stupid moron you are the and hate dumb loser is it this that".split()


@pytest.fixture(scope="module")
def channel():
    counts = np.zeros(tx.SYMBOLS**3, np.int64)
    for word in LEXICON * 50:
        s, _ = tx.symbols([word])
        np.add.at(counts, (s[:-2] << 12) | (s[1:-1] << 6) | s[2:], 1)
    return Channel(counts)


def readings(token):
    """Every sequence of letters behind a token, with the price of its disguise."""
    def step(rest, word, cost):
        if not rest:
            yield word, cost
            return
        c, more = rest[0], rest[1:]
        options = [(c, 0.0)] if c.isalpha() else [(x, SIGN) for x in STANDS_FOR.get(c, "")]
        for x, price in options:
            yield from step(more, word + x, cost + price)
            if word and word[-1] == x:
                yield from step(more, word, cost + price + REPEAT)
        if not c.isalpha():
            yield from step(more, word, cost + (SKIP_SIGN if options else SKIP))

    return step(token, "", 0.0)


def priced(channel, word, cost):
    symbols = [0, 0, *(int(tx.symbol_table()[ord(x)]) for x in word), 0]
    return cost + sum(float(channel.price[a, b, c]) for a, b, c in zip(symbols, symbols[1:], symbols[2:]))


def test_search_is_exact(channel):
    rng = random.Random(6)
    for _ in range(400):
        token = "".join(rng.choices("shitkilo10$@!.-5", k=rng.randint(1, 6)))
        best = min(priced(channel, w, c) for w, c in readings(token))
        found = channel.restore(token)
        if found == token and not token.isalpha():
            assert channel._plain(token) <= best + 1e-3
        else:
            assert any(w == found and priced(channel, w, c) <= best + 1e-3 for w, c in readings(token)), token


@pytest.mark.parametrize("written,meant", [("$h1t", "shit"), ("k1ll", "kill"), ("1d10t", "idiot"), ("@$$", "ass"), ("s.h.i.t", "shit"), ("shiiiit", "shit"), ("he11o!", "hello"), ("2023", "2023")])
def test_disguises(channel, written, meant):
    assert Words(channel).restored(written) == meant


def test_length_makes_no_difference(channel):
    words = Words(channel)
    assert words.restored("-".join("idiot" * 40)) == "idiot" * 40
    assert words.restored("s" * 20_000 + "h1t") == "shit"


def test_toxicity_of_odd_tables(spark):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(1, 1, "a"), (2, 0, "b"), (None, 1, "c"), (2, None, "d")], "doc_id int, toxic int, text string")
    docs = spark.createDataFrame([(1, "you idiot", 5.0), (2, "hello you", 6.0), (None, None, 7.0), (2, "", None)], "doc_id int, text string, n double")
    found = toxicity(spark, docs, labels, F.lit(True)).collect()
    assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)
    assert toxicity(spark, docs.where("false"), labels, F.lit(True)).count() == 0


def cheapest(points, cost, size):
    """Least total price of all ways to cut a line."""
    places, best = points.tolist(), float("inf")
    for chosen in itertools.product([False, True], repeat=len(places) - 1):
        ends = [p for p, c in zip(places, [*chosen, True]) if c]
        total, at = 0, 0
        for end in ends:
            n = end - at
            if n > size:
                break
            least = min(packing.LEAST, size)
            free = n & (n - 1) == 0 and n >= least
            total += packing.WINDOW + (0 if free else size - n) + int(cost[places.index(end)])
            at = end
        else:
            best = min(best, total)
    return best


def test_cuts_cost_least():
    rng = random.Random(8)
    for _ in range(150):
        size = rng.choice([8, 16, 32])
        gaps = [rng.randint(1, size) for _ in range(rng.randint(1, 9))]
        points = np.cumsum(gaps)
        cost = np.array([rng.choice([0, 2, 12]) for _ in gaps])
        ends = packing.cuts(points, cost, size)
        assert ends[-1] == points[-1]
        total, at = 0, 0
        for end in ends:
            n = end - at
            assert 0 < n <= size
            free = n & (n - 1) == 0 and n >= min(packing.LEAST, size)
            total += packing.WINDOW + (0 if free else size - n) + int(cost[points.tolist().index(end)])
            at = end
        assert total == cheapest(points, cost, size)


def test_special_strings_are_special_tokens():
    path, ranks = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
    plain, coder = Tokenizer.from_file(path), packing.token_ids(path, ranks)
    rng = random.Random(1)
    bits = ["<|endoftext|>", "<|", "|>", " ", "a", "hello", "\n\n", "  ", "é", "<|endoftext|"]
    for _ in range(500):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert list(coder.encode(text)) == plain.encode(text, add_special_tokens=False).ids
