"""Words and shingles of Arrow text columns as 64-bit hashes, with numpy over raw UTF-8 bytes.

A word is a run of bytes other than tab, newline, vertical tab, form feed, return and space; A-Z count as
a-z. A word's hash is a polynomial of its bytes modulo 2^64, taken from running sums, so a whole slice of
texts is hashed at once. Texts are worked in slices of a few MB, a longer text in a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Separators where punctuation doesn't count: all ASCII but letters and digits.
PUNCTUATION = np.array([k < 128 and not chr(k).isalnum() for k in range(256)])


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            self.up, self.down = (
                np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
                for base in (_BASE % 2**64, pow(_BASE, -1, 2**64))
            )
        return self.up, self.down


_POWERS = _Powers()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, byte bounds of the rows)``; null texts are empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at, rows = 0, len(column)
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, rows)
        yield at, to, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(
    raw: np.ndarray, bounds: np.ndarray, apart: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, first byte and byte after the last of every word of a slice; ``apart`` marks separating bytes."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Compared bytes take less time than looked up ones.
    solid = (raw != 32) & (raw - np.uint8(9) > 4) if apart is _SPACE else ~apart[raw]
    before = np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    before[bounds[:-1][bounds[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, solid[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    up, down = _POWERS.upto(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    lower = (raw | (raw - np.uint8(65) < 26).view(np.uint8) << 5).astype(np.uint64)
    lower += np.uint64(1)
    lower *= up[:n]
    np.cumsum(lower, out=sums[1:])
    del lower
    hashes = mix((sums[end] - sums[start]) * down[start])
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(start, bounds)))
    return hashes, row, start, end


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words of one sequence of word hashes."""
    n = len(hashes) - size + 1
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k : k + n]
    return mix(out)


def whole(hashes: np.ndarray) -> np.ndarray:
    """Hash of a sequence as one element, apart from the hashes of runs."""
    out = np.array([len(hashes)], np.uint64)
    for k in range(len(hashes)):
        out = out * _STEP + hashes[k : k + 1]
    return mix(~out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct runs of ``size`` words, sorted; the whole sequence as one where it is shorter."""
    if len(hashes) >= size:
        return np.unique(runs(hashes, size))
    return whole(hashes) if len(hashes) else np.zeros(0, np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


SYMBOLS = 64


def _symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1-26 for a-z, 27-63 for other letters."""
    table = np.zeros(0x110000, np.uint8)
    for k in range(0x30000):
        if chr(k).isalpha():
            table[k] = k - 96 if 97 <= k <= 122 else 27 + (k * 2654435761 >> 7) % 37
    return table


_symbols: np.ndarray | None = None


def symbol_table() -> np.ndarray:
    global _symbols
    if _symbols is None:
        _symbols = _symbol_table()
    return _symbols


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of lower-cased texts, each between two zeros, runs of zeros being one; and the bounds of the texts."""
    points = np.frombuffer("\x00".join(["", *[t.lower() for t in texts], ""]).encode("utf-32-le", "replace"), np.uint32)
    out = symbol_table()[points]
    # A null character ends each text; one inside a text would move the bounds, so texts come without them.
    ends = np.flatnonzero(points == 0)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    keep[ends] = True
    place = np.cumsum(keep) - 1
    return out[keep].astype(np.int64), place[ends]
