"""Counts of all rows in a fixed number of cells, and small fits on them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_PARTS = 64
# Cells counted by a table of their own at each turn, and cells of a turn.
_SMALL = 1 << 20
_SCHEMA = "part int, counts binary"


def _packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(parts), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in parts.values()], pa.binary())],
        names=["part", "counts"],
    )


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.int64)


def count_cells(df: DataFrame, size: int, cells: Callable[[Iterator[pa.RecordBatch]], Iterable[np.ndarray]]) -> np.ndarray:
    """How often each cell below ``size`` occurs in the integer arrays that ``cells`` makes of the rows of ``df``.

    A task counts into one array of ``size`` counters and sends it in compressed parts, which are summed by part;
    the driver gets ``size`` counters, however many rows there are. ``size`` is a multiple of 64.
    """

    def count(batches):
        sums = np.zeros(size, np.int64)

        def tally(held):
            if size <= _SMALL:
                sums[:] += np.bincount(np.concatenate(held), minlength=size)
            else:
                # No second table of that size.
                met, times = np.unique(np.concatenate(held), return_counts=True)
                sums[met] += times

        held, n = [], 0
        for found in cells(batches):
            held.append(found)
            n += len(found)
            if n > _SMALL:
                tally(held)
                held, n = [], 0
        if held:
            tally(held)
        for k, part in enumerate(np.split(sums, _PARTS)):
            if part.any():
                yield _packed({k: part})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + _unpacked(packed)
        yield _packed(sums)

    out = np.zeros((_PARTS, size // _PARTS), np.int64)
    for row in df.mapInArrow(count, _SCHEMA).repartition(_PARTS, "part").mapInArrow(add, _SCHEMA).collect():
        out[row["part"]] = _unpacked(row["counts"])
    return out.ravel()


def mark_cells(df: DataFrame, size: int, cells: Callable[[Iterator[pa.RecordBatch]], Iterable[np.ndarray]]) -> np.ndarray:
    """Packed bits of the cells below ``size`` that occur in the integer arrays that ``cells`` makes of ``df``.

    Like ``count_cells``, with a bit a cell. ``size`` is a multiple of 512. Small tables are joined in few tasks."""
    pieces = _PARTS if size > _SMALL << 4 else _PARTS // 8

    def mark(batches):
        marks = np.zeros(size // 8, np.uint8)
        for found in cells(batches):
            cell = np.unique(found)
            at, bit = cell >> 3, (128 >> (cell & 7)).astype(np.uint8)
            start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else at
            marks[at[start]] |= np.bitwise_or.reduceat(bit, start) if len(at) else bit
        for k, part in enumerate(np.split(marks, pieces)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["part", "counts"])

    def join(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = np.frombuffer(zlib.decompress(packed), np.uint8)
                parts[part] = parts[part] | bits if part in parts else bits
        yield _packed(parts)

    out = np.zeros((pieces, size // 8 // pieces), np.uint8)
    for row in df.mapInArrow(mark, _SCHEMA).repartition(pieces, "part").mapInArrow(join, _SCHEMA).collect():
        out[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return out.ravel()


def bit_table(keys: DataFrame, each: int = 8, least: int = 1 << 20, most: int = 1 << 29, n: int | None = None):
    """Broadcast bit table of the bigint column ``key``, at least ``each`` bits a key up to ``most`` bits.

    ``n`` is the number of keys, which are counted without it."""
    keys = keys.select("key")
    size = min(max(least, 1 << (each * (keys.count() if n is None else n) + 1).bit_length()), most)

    def cells(batches):
        for batch in batches:
            yield batch.column(0).to_numpy(zero_copy_only=False) & (size - 1)

    return keys.sparkSession.sparkContext.broadcast(mark_cells(keys, size, cells))


def has_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned ``keys`` may be in a bit table; of others a few."""
    cell = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the first weight is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = ridge * len(x) * np.eye(x.shape[1])
    keep[0, 0] = 1e-6 * len(x) + 1e-9
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
