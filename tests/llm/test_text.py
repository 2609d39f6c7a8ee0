"""Hashed words and shingles against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from shelfwatch.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", "   ", "One two", "one\ttwo\nTHREE  four", "é ü 😀 x", "a" * 5000, "one two", "\x00 \x00\x00", " lead trail "]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_words_are_the_pattern_matches(limit):
    seen, found = {}, [[] for _ in TEXTS]
    for at, to, raw, bounds in tx.slices(pa.array(TEXTS), limit):
        hashes, rows, start, end = tx.words(raw, bounds)
        for h, r, s, e in zip(hashes.tolist(), rows.tolist(), start.tolist(), end.tolist()):
            found[at + r].append((h, lowered(raw[s:e].tobytes().decode())))
    for text, words in zip(TEXTS, found):
        assert [w for _, w in words] == WORD.findall(lowered(text))
        for h, w in words:
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_of_sliced_and_empty_columns():
    column = pa.array(["x", "ab", None, "cd"]).slice(1)
    assert [raw.tobytes() for _, _, raw, _ in tx.slices(column)] == [b"abcd"]
    assert list(tx.slices(pa.array([], pa.string()))) == []


def test_shingles():
    h = np.array([1, 2, 1, 2, 1], np.uint64)
    assert len(tx.shingles(h, 2)) == 2
    assert len(tx.shingles(h[:1], 2)) == 1
    assert len(tx.shingles(h[:0], 2)) == 0
    assert tx.shingles(h[:2], 4) != tx.shingles(h[1:3], 4)
    assert tx.shingles(h[:2], 2) != tx.shingles(h[:2], 4)


def test_symbols_bounds():
    symbols, ends = tx.symbols(["ab", "", "C3d", "é"])
    assert len(ends) == 5
    assert [symbols[a + 1 : b].tolist() for a, b in zip(ends, ends[1:])][:3] == [[1, 2], [], [3, 0, 4]]
