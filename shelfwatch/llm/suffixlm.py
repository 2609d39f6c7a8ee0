"""Probabilistic suffix tree over words, built and applied by Spark.

Tokens are words and one end for each text. A node of the tree is a context of up to ``depth`` preceding words; levels are
added until none has a context left. Counts come from all training rows. A context is kept if its parent, which lacks the
first word, is kept, it was seen often enough, and its next words diverge from its parent's prediction: the log-likelihood
gain over its frequent followers must exceed half a log count for each of them. A kept context predicts by absolute
discounting with its parent:

    p(w | s) = (c(s, w) - D) / c(s) + g(s) p(w | parent(s))        p(w) = (c(w) + 1) / (N + V + 1)

Followers seen once, and rare words, are left to the parent, so g(s) is what remains. A text's log probability under its
longest kept suffixes is then a sum over its words and word runs of one number each. Tasks know the numbers of the
most frequent runs (a broadcast table of at most ``HEAD`` rows) and add them up in place; all others meet in
buckets of their hashes, so neither the model nor a text's neighbours are gathered anywhere.

Runs are counted, and looked up, in blocks: a task takes the runs of a chunk of texts and cuts them by hash into buckets, whose
number follows the size of the texts. A run can only repeat if the run without its first word does. A run is only looked up
if the context before its last word, or the run without its first word, may be a kept context.
Bit tables of the keys (eight bits a key, 2^29 at most) let tasks skip runs that can't count or aren't in the model; a wrong
bit only costs a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwatch.llm import text as tx
from shelfwatch.llm.counters import bit_table, has_bit
from shelfwatch.llm.storage import Scratch

DISCOUNT = 0.75
# A context, and a word as a follower, must have been seen this often in training.
CONTEXT_COUNT, FOLLOWER_COUNT = 50, 5
DEPTH = 4
CHUNK_TOKENS = 1 << 20
# Columns of a chunk's runs are made for so many places at a time, and sorted in so many ranges of their keys.
PART_TOKENS, RANGES = 1 << 16, 8
# Runs of all lengths are looked up at once, so in smaller chunks.
LOOK_UP_TOKENS = 1 << 19
# Rows of the model that every task gets; the others are looked up in buckets.
HEAD = 1 << 20
# Bytes of text for each bucket of looked up runs. A bucket sends one sum a text, so fewer buckets send less.
BUCKET_BYTES = 1 << 24
END = np.uint64(0x1B873593CC9E2D51)
SUMS = ["base", "score", "known"]
OWN = ["chunk", "place", "id", "held_out", "n"]


def _tokens(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_TOKENS):
    """``(first row, rows' batches and places, token hashes, token rows)`` in chunks of about ``limit`` tokens."""
    held, rows, size, first, n = [], [], 0, 0, 0
    owners = []
    for batch in batches:
        for at, to, raw, bounds in tx.slices(batch.column(0)):
            hashes, row, _, _ = tx.words(raw, bounds)
            cuts = np.searchsorted(row, np.arange(to - at + 1))
            # One end after each text's words.
            place = np.arange(len(hashes)) + row
            out = np.full(len(hashes) + to - at, END, np.uint64)
            out[place] = hashes
            held.append(out)
            rows.append(np.repeat(np.arange(n, n + to - at, dtype=np.int32), np.diff(cuts) + 1))
            owners.append(batch.slice(at, to - at))
            n += to - at
            size += len(out)
            if size > limit:
                yield first, owners, _one(held), _one(rows)
                first, n, owners, size = first + n, 0, [], 0
    if held:
        yield first, owners, _one(held), _one(rows)


def _one(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array; the list is emptied, so that a chunk is not held twice."""
    out = np.concatenate(parts)
    parts.clear()
    return out


def _join(*parts: np.ndarray) -> np.ndarray:
    """Hash of a sequence of tokens."""
    out = parts[0]
    for p in parts[1:]:
        out = tx.mix(out * np.uint64(0x9FB21C651E98DF25) + p)
    return out


def _grams(tokens: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Rows, context keys, parent-and-word keys, words and keys of the runs of ``size`` tokens within a text."""
    n = len(tokens) - size + 1
    if n <= 0:
        empty = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), empty, empty, empty, empty
    inside = rows[:n] == rows[size - 1 :]
    parts = [tokens[k : k + n][inside] for k in range(size)]
    return rows[:n][inside], _join(*parts[:-1]), _join(*parts[1:]), parts[-1], _join(*parts)


def _countable(tokens: np.ndarray, rows: np.ndarray, size: int, contexts, words, suffixes) -> tuple[np.ndarray, ...]:
    """Context, parent-and-word keys, words and keys of the runs of ``size`` tokens that the bit tables let count.

    A column is only made for the runs that are left, so a chunk never holds all columns of all runs."""
    n = max(0, len(tokens) - size + 1)
    at = np.flatnonzero(rows[:n] == rows[size - 1 : size - 1 + n])
    at = at[has_bit(words.value, tokens[at + size - 1])]
    context = _join(*(tokens[at + k] for k in range(size - 1)))
    may = has_bit(contexts.value, context)
    at, context = at[may], context[may]
    suffix = _join(*(tokens[at + k] for k in range(1, size)))
    if suffixes is not None:
        may = has_bit(suffixes.value, suffix)
        at, context, suffix = at[may], context[may], suffix[may]
    word = tokens[at + size - 1]
    return context, suffix, word, _join(context, word)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``keys`` begins."""
    first = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=first[1:])
    return np.flatnonzero(first)


def _distinct(tokens: np.ndarray, rows: np.ndarray, size: int, contexts, words, suffixes) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted keys, context, suffix, word and number of a chunk's countable runs, each run once, by ranges of the keys.

    Only tokens, columns of the countable runs and one range's sorted columns are held at a time."""
    held, m = np.empty((4, max(0, len(tokens) - size + 1)), np.uint64), 0
    for at in range(0, held.shape[1], PART_TOKENS):
        part = slice(at, at + PART_TOKENS + size - 1)
        for column, made in zip(held, _countable(tokens[part], rows[part], size, contexts, words, suffixes), strict=True):
            column[m : m + len(made)] = made
        m += len(made)
    held = held[:, :m]
    ranges = ((held[3] >> np.uint64(32)) * np.uint64(RANGES) >> np.uint64(32)).astype(np.uint8)
    for k in range(RANGES):
        at = np.flatnonzero(ranges == k)
        at = at[np.argsort(held[3, at])]
        keys = held[3, at]
        start = _starts(keys)
        n = np.diff(np.r_[start, len(keys)])
        at = at[start]
        yield keys[start], held[0, at], held[1, at], held[2, at], n


def _word_counts(texts: DataFrame) -> DataFrame:
    def rows(batches):
        for _, _, tokens, _ in _tokens(batches):
            keys, n = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(keys)), pa.array(n)], names=["key", "n"])

    return texts.mapInArrow(rows, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("c"))


def _dealt(keys: np.ndarray, buckets: int, *columns: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Buckets of the sorted ``keys``, and the columns of each bucket as one block, bytes of a rank together: of sorted keys
    the first ones, and of small numbers the last ones, then compress."""
    if not len(keys):
        return np.zeros(0, np.int32), []
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[start[1:], len(keys)]
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(keys), -1) for c in columns]
    return bucket[start].astype(np.int32), [b"".join(p[i:j].T.tobytes() for p in planes) for i, j in zip(start, ends, strict=True)]


def _unpacked(block: bytes, *types: str) -> list[np.ndarray]:
    """The columns of a block."""
    sizes = [np.dtype(t).itemsize for t in types]
    m, out, at = len(block) // sum(sizes), [], 0
    for kind, size in zip(types, sizes, strict=True):
        planes = np.frombuffer(block, np.uint8, m * size, at).reshape(size, m)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += m * size
    return out


def _merged(held: list[np.ndarray]) -> np.ndarray:
    """Equal runs of blocks made one; the columns are context, word, suffix and count. The list is emptied."""
    rows = np.concatenate(held, axis=1)
    held.clear()
    key = _join(rows[0], rows[1])
    order = np.argsort(key)
    start = _starts(key[order])
    del key
    out = rows[:, order[start]]
    out[3] = np.add.reduceat(rows[3, order], start) if len(start) else 0
    return out


def _gram_counts(texts: DataFrame, size: int, tokens: int, contexts, words, suffixes) -> DataFrame:
    """Counts of at least two of runs of ``size`` tokens, their contexts, words and suffixes being in the bit tables.

    ``tokens`` is the number of training tokens, or of those that end a run of the suffix table. A pair's suffix is its word,
    and ``suffixes`` None."""
    buckets = max(1, -(-tokens // max(1, CHUNK_TOKENS // 2)))

    def blocks(batches):
        for _, _, found, row in _tokens(batches):
            for keys, context, suffix, word, n in _distinct(found, row, size, contexts, words, suffixes):
                columns = [context, word, *([suffix] if suffixes is not None else [])]
                bucket, packed = _dealt(keys, buckets, *columns, n.astype("<u4"))
                for at in range(0, len(packed), 4096):
                    part = [pa.array(bucket[at : at + 4096]), pa.array(packed[at : at + 4096], pa.binary())]
                    yield pa.RecordBatch.from_arrays(part, names=["bucket", "runs"])

    wide = 2 if suffixes is None else 3

    def merge(batches):
        held, n = [], 0
        for batch in batches:
            for runs in batch.column(1):
                columns = _unpacked(runs.as_py(), *["<u8"] * wide, "<u4")
                # A pair's suffix is its word.
                held.append(np.stack([*columns[:2], columns[wide - 1], columns[-1].astype(np.uint64)]))
                n += len(columns[0])
                if n > CHUNK_TOKENS and len(held) > 1:
                    held = [_merged(held)]
                    n = held[0].shape[1] // 2
        if held:
            rows = _merged(held)
            rows = rows[:, rows[3] >= 2]
            for at in range(0, rows.shape[1], 50_000):
                part = np.ascontiguousarray(rows[:, at : at + 50_000])
                columns = [_join(part[0], part[1]), *part]
                yield pa.RecordBatch.from_arrays([pa.array(tx.signed(c)) for c in columns], names=["key", "context", "word", "suffix", "c"])

    # Spark deals a bucket's blocks to the task of its number.
    dealt = texts.mapInArrow(blocks, "bucket int, runs binary").repartitionById(buckets, F.col("bucket"))
    return dealt.mapInArrow(merge, "key bigint, context bigint, word bigint, suffix bigint, c bigint")


def _level(scratch: Scratch, grams: DataFrame, contexts: DataFrame, below: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept nodes ``(key, spare, c)`` and their runs' ``(key, c, p, gain)`` of one depth, as written tables.

    ``grams(key, context, suffix, c)``; ``contexts(key, total)``; ``below(key, p)`` predicts a follower by the parent,
    by its key ``suffix``. ``spare`` is log10 g(s), ``gain`` log10 p(w | s) - log10 (g(s) p(w | parent)). A run whose context
    isn't kept has neither: no run of the next depth has it as its suffix, as parents of contexts are kept.
    """
    placed = grams.join(contexts.select(F.col("key").alias("context"), "total"), "context").join(
        below.select(F.col("key").alias("suffix"), "p"), "suffix"
    )
    placed = scratch.store(placed.select("key", "context", "c", "total", "p"), "placed")
    share = (F.col("c") - DISCOUNT) / F.col("total")
    nodes = placed.groupBy("context").agg(
        F.sum(share).alias("taken"), F.count("*").alias("k"), F.first("total").alias("c"),
        F.sum(F.col("c") * F.log(F.col("c") / F.col("total") / F.col("p"))).alias("won"),
    ).where("won > 0.5D * k * ln(c)").select(F.col("context").alias("key"), F.log10(1 - F.col("taken")).alias("spare"), "c")
    nodes = scratch.store(nodes, "nodes")
    left = F.pow(F.lit(10.0), F.col("spare")) * F.col("p")
    followers = placed.join(nodes.select(F.col("key").alias("context"), "spare"), "context").select(
        "key", "c", (share + left).alias("p"), (F.log10(share + left) - F.log10(left)).alias("gain")
    )
    followers = scratch.store(followers, "followers")
    scratch.drop(placed)
    return nodes, followers


class _Numbers:
    """Base and value of words or runs, by sorted key; rows of a key have one base, their values are added."""

    def __init__(self, keys: np.ndarray, base: np.ndarray, value: np.ndarray) -> None:
        order = np.argsort(keys)
        start = _starts(keys[order])
        self.keys, self.base = keys[order[start]], base[order[start]]
        self.value = np.add.reduceat(value[order], start) if len(start) else value
        # Where the keys of each cell of their span begin, as a bucket's keys share first bits; a last key ends every search.
        self.low, self.high = (self.keys[0], self.keys[-1]) if len(start) else (np.uint64(0), np.uint64(0))
        span = int(self.high) - int(self.low)
        self.shift = np.uint64(max(0, span.bit_length() - len(start).bit_length()))
        cells = self.low + (np.arange((span >> int(self.shift)) + 1, dtype=np.uint64) << self.shift)
        self.first = np.searchsorted(self.keys, cells).astype(np.int32)
        self.keys = np.r_[self.keys, ~np.uint64(0)]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``keys`` are here, and the places of those."""
        at = self.first[(np.clip(keys, self.low, self.high) - self.low >> self.shift).astype(np.int64)]
        left = np.flatnonzero(self.keys[at] < keys)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] < keys[left]]
        here = (self.keys[at] == keys) & (at < len(self.value))
        return here, at[here]


def _alone(counts: np.ndarray, total: int) -> np.ndarray:
    """Log10 probabilities of words by their counts alone; ``total`` is N + V + 1."""
    return np.log10((counts + 1) / total)


def _head(model: DataFrame, total: int) -> tuple[dict[bool, _Numbers], DataFrame, int]:
    """At most ``HEAD`` rows of the model with the highest counts, words and runs apart, the others, and their number.

    Counts fall in classes of a ninth more each; the head is the highest classes that fit. Rows of a key have one count."""
    heat = F.floor(8 * F.log2("c")).cast("int")
    classes = sorted(model.groupBy(heat.alias("heat")).count().collect(), key=lambda r: -r["heat"])
    left, least, others = HEAD, 8 * 62, sum(row["count"] for row in classes)
    for row in classes:
        left -= row["count"]
        if left < 0:
            break
        least, others = row["heat"], others - row["count"]
    # The least count of the class, as plain counts are compared in the files.
    least = math.ceil(2 ** (least / 8))
    rows = model.where(F.col("c") >= least).select("key", "word", "c", "value").toArrow()
    is_word = rows.column("word").to_numpy().astype(bool)
    key, counts, value = (rows.column(c).to_numpy() for c in ("key", "c", "value"))
    head = {w: _Numbers(key[is_word == w].view(np.uint64), _alone(counts[is_word == w], total), value[is_word == w]) for w in (True, False)}
    return head, model.where(F.col("c") < least), others


def _candidates(tokens: np.ndarray, rows: np.ndarray, longest: int, kept) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(size, rows, keys)`` of the words and of the runs up to ``longest`` that may be in the model: runs after a kept
    context, and runs whose suffix is a kept context, as they may be kept ones too."""
    yield 1, rows, tokens
    before = has_bit(kept.value, tokens)
    for size in range(2, longest + 1):
        n = max(0, len(tokens) - size + 1)
        at = np.flatnonzero((before[:n] | before[1 : n + 1]) & (rows[:n] == rows[size - 1 : size - 1 + n]))
        key = _join(*(tokens[at + k] for k in range(size)))
        before = np.zeros(n, bool)
        before[at] = has_bit(kept.value, key)
        yield size, rows[at], key


def _occurrences(rows: DataFrame, id_type: str, longest: int, buckets: int, unseen: float, head, kept, tail) -> DataFrame:
    """Rows of two kinds: a text's own ``(chunk, place, id, held_out, n)``, with its sums over what the head holds and over
    unseen words, and blocks of a bucket's other words or runs in a chunk: key, place of the text, and count."""

    def out(batches):
        base = TaskContext.get().partitionId() << 33
        for first, owners, tokens, row in _tokens(batches, LOOK_UP_TOKENS):
            sizes = np.bincount(row)
            m = len(sizes)
            found = {True: [], False: []}
            for size, at, key in _candidates(tokens, row, longest, kept):
                word = size == 1
                here, place = head.value[word].find(key)
                value = head.value[word].value[place]
                if word:
                    alone = head.value[word].base[place]
                    sums = [np.bincount(at[here], w, m).astype(float) for w in (alone, value + alone, np.ones(len(place)))]
                else:
                    sums[1] += np.bincount(at[here], value, m)
                at, key = at[~here], key[~here]
                rest = has_bit(tail.value, key)
                if word:
                    new = np.bincount(at[~rest], minlength=m) * unseen
                    sums[0] += new
                    sums[1] += new
                found[word].append((key[rest], at[rest]))
            chunk = base + first
            ids, held = (pa.chunked_array([b.column(k) for b in owners]).combine_chunks() for k in (1, 2))
            own = [pa.array(np.full(m, chunk)), pa.array(np.arange(m, dtype=np.int32)), ids, held, pa.array(sizes)]
            # A chunk's own rows pass through any bucket.
            bucket = pa.array(np.full(m, int(tx.mix(np.array([chunk], np.uint64))[0] % np.uint64(buckets)), np.int32))
            nothing = [pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary())]
            yield pa.RecordBatch.from_arrays([bucket, *own, *(pa.array(v) for v in sums), *nothing], names=names)
            for word, parts in found.items():
                key, at = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (tokens[:0], row[:0])
                order = np.argsort(key)
                key, at = key[order], at[order]
                start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (at[1:] != at[:-1])]) if len(key) else order
                n = np.diff(np.r_[start, len(key)])
                key = key[start]
                part, blocks = _dealt(key, buckets, key, at[start].astype("<u4"), n.astype("<u4"))
                for k in range(0, len(blocks), 4096):
                    j = len(blocks[k : k + 4096])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part[k : k + j]), pa.array(np.full(j, chunk)), pa.nulls(j, pa.int32()), pa.nulls(j, ids.type),
                            pa.nulls(j, pa.bool_()), pa.nulls(j, pa.int64()), *[pa.nulls(j, pa.float64())] * 3,
                            pa.array(np.full(j, word)), pa.array(blocks[k : k + j], pa.binary()),
                        ],
                        names=names,
                    )

    names = ["bucket", *OWN, *SUMS, "word", "block"]
    return rows.mapInArrow(out, f"bucket int, {_own(id_type)}, word boolean, block binary")


def _own(id_type: str) -> str:
    return f"chunk bigint, place int, id {id_type}, held_out boolean, n bigint, " + ", ".join(f"{c} double" for c in SUMS)


def _model_blocks(model: DataFrame, buckets: int) -> DataFrame:
    """The model's rows as blocks of a bucket: key, value and, of words, count."""

    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK_TOKENS:
                yield from cut(held)
                held, n = [], 0
        if held:
            yield from cut(held)

    def cut(held):
        table = pa.Table.from_batches(held)
        is_word = table.column("word").to_numpy().astype(bool)
        key, counts, value = (table.column(c).to_numpy() for c in ("key", "c", "value"))
        for word in (True, False):
            numbers = _Numbers(key[is_word == word].view(np.uint64), counts[is_word == word], value[is_word == word])
            columns = [numbers.keys[:-1], numbers.value.astype("<f8"), *([numbers.base.astype("<u8")] if word else [])]
            bucket, packed = _dealt(columns[0], buckets, *columns)
            for k in range(0, len(packed), 4096):
                part = [pa.array(bucket[k : k + 4096]), pa.array(np.full(len(packed[k : k + 4096]), word)), pa.array(packed[k : k + 4096], pa.binary())]
                yield pa.RecordBatch.from_arrays(part, names=["bucket", "word", "block"])

    return model.select("key", "word", "c", "value").mapInArrow(blocks, "bucket int, word boolean, block binary")


def _sums(seen: DataFrame, model: DataFrame, id_type: str, buckets: int, total: int) -> DataFrame:
    """Texts with their sums over head and buckets: a bucket's runs find their numbers, which are then added up by chunk.

    A bucket sends sums of base and known words, and sums of values, each for the texts that have any."""
    names = [*OWN, *SUMS, "word", "block"]

    def look_up(batches):
        known, wanted = {True: [], False: []}, {True: [], False: []}
        for batch in batches:
            own = batch.filter(pc.is_null(batch.column("block")))
            if own.num_rows:
                yield own.select(names)
            for row in batch.filter(pc.is_valid(batch.column("block"))).select(["word", "chunk", "block"]).to_pylist():
                if row["chunk"] is None:
                    known[row["word"]].append(_unpacked(row["block"], "<u8", "<f8", *(["<u8"] if row["word"] else [])))
                else:
                    wanted[row["word"]].append((row["chunk"], row["block"]))
        values: dict[int, list] = {}
        for word in (True, False):
            if not wanted[word]:
                continue
            nothing = [np.zeros(0, np.uint64), np.zeros(0), *([np.zeros(0, np.uint64)] if word else [])]
            key, value, *counts = (np.concatenate(c) for c in zip(nothing, *known[word], strict=True))
            numbers = _Numbers(key, *counts or [value], value)
            for chunk, block in wanted[word]:
                key, at, n = _unpacked(block, "<u8", "<u4", "<u4")
                here, place = numbers.find(key)
                if word:
                    counts = np.zeros(len(key))
                    counts[here] = numbers.base[place]
                    yield sums(chunk, True, at, (n * _alone(counts, total), "<f8"), (n * here, "<u4"))
                at, value = at[here], n[here] * numbers.value[place]
                values.setdefault(chunk, []).append((at[value != 0], value[value != 0]))
        for chunk, parts in values.items():
            at, value = (np.concatenate(c) for c in zip(*parts, strict=True))
            if len(at):
                yield sums(chunk, False, at, (value, "<f8"))

    def sums(chunk, word, at, *columns):
        place, owner = np.unique(at, return_inverse=True)
        added = [np.bincount(owner, v, len(place)).astype(kind) for v, kind in columns]
        block = _dealt(np.zeros(len(place), np.uint64), 1, place, *added)[1]
        return pa.RecordBatch.from_arrays([pa.array([chunk]), *(pa.nulls(1, t) for t in kinds), pa.array([word]), pa.array(block, pa.binary())], names=names)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        texts = []
        for batch in batches:
            texts.append(batch.filter(pc.is_null(batch.column("block"))).drop_columns(["word", "block"]))
            for row in batch.filter(pc.is_valid(batch.column("block"))).select(["chunk", "word", "block"]).to_pylist():
                place, *added = _unpacked(row["block"], "<u4", "<f8", *(["<u4"] if row["word"] else []))
                held = sums.setdefault(row["chunk"], np.zeros((3, 0)))
                if place.max() >= held.shape[1]:
                    held = sums[row["chunk"]] = np.pad(held, ((0, 0), (0, int(place.max()) + 1 - held.shape[1])))
                if row["word"]:
                    held[0, place] += added[0]
                    held[2, place] += added[1]
                held[1, place] += added[0]
        for batch in texts:
            out = [batch.column(c).to_numpy().copy() for c in SUMS]
            chunk, place = (batch.column(c).to_numpy() for c in ("chunk", "place"))
            for one in np.unique(chunk):
                held = sums.get(int(one))
                if held is not None:
                    mine = np.flatnonzero(chunk == one)
                    mine = mine[place[mine] < held.shape[1]]
                    for k in range(3):
                        out[k][mine] += held[k][place[mine]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in OWN), *(pa.array(v) for v in out)], names=names[:-2])

    kinds = [pa.int32(), to_arrow_type(seen.schema["id"].dataType), pa.bool_(), pa.int64(), *[pa.float64()] * 3]
    blocks = _model_blocks(model, buckets)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in seen.schema if f.name not in blocks.columns]
    both = seen.union(blocks.select("*", *empty).select(*seen.columns))
    found = both.repartitionById(buckets, F.col("bucket")).mapInArrow(look_up, f"{_own(id_type)}, word boolean, block binary")
    return found.repartition(buckets, "chunk").mapInArrow(add, _own(id_type))


def suffix_scores(
    spark: SparkSession, docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    depth: int = DEPTH,
) -> DataFrame:
    """``(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``.

    Rows where ``held_out`` is not true are learned from. ``base_score`` is the log10 probability of the text under
    smoothed word counts alone, ``score`` under the suffix tree. A null or empty text is one end. Rows with null or
    repeated ids are scored, and learned from, as often as they occur. Without training rows every token has
    probability 1. Other columns are not read.
    """
    scratch = Scratch(spark, "suffix")
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    id_type = rows.schema["id"].dataType.simpleString()
    train = rows.where("NOT held_out").select("text")

    words = scratch.store(_word_counts(train), "words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    p0 = words.select("key", "c", ((F.col("c") + 1) / F.lit(float(n + v + 1))).alias("p"))
    often = bit_table(words.where(F.col("c") >= FOLLOWER_COUNT))
    end = int(tx.signed(np.array([END]))[0])

    contexts = words.where((F.col("c") >= CONTEXT_COUNT) & (F.col("key") != end)).select("key", F.col("c").alias("total"))
    contexts = scratch.store(contexts, "contexts")
    below, suffixes, places, levels = p0.select("key", "p"), None, n, []
    while len(levels) < depth:
        grams = _gram_counts(train, len(levels) + 2, places, bit_table(contexts), often, suffixes)
        grams = scratch.store(grams, "runs")
        nodes, followers = _level(scratch, grams, contexts, below)
        levels.append((nodes, followers))
        # A run is a context if its parent is a kept one.
        used, contexts = contexts, scratch.store(
            grams.where((F.col("c") >= CONTEXT_COUNT) & (F.col("word") != end))
            .join(nodes.select(F.col("key").alias("suffix")), "suffix", "left_semi").select("key", F.col("c").alias("total")),
            "contexts",
        )
        scratch.drop(grams, used)
        if contexts.isEmpty():
            break
        # A longer run is counted where its suffix is.
        places, size = followers.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        below, suffixes = followers.select("key", "p"), bit_table(followers, n=size)
    scratch.drop(contexts)

    # A word may be a context; a run may be a follower, a context, or both. Their rows' values are added where they are read.
    model = [words.select("key", F.lit(True).alias("word"), "c", F.lit(0.0).alias("value"))]
    for k, (nodes, followers) in enumerate(levels):
        model.append(nodes.select("key", F.lit(k == 0), "c", "spare"))
        model.append(followers.select("key", F.lit(False), "c", "gain"))
    model = reduce(DataFrame.union, model)
    nodes = reduce(DataFrame.union, [words.select("key").limit(0), *(nodes.select("key") for nodes, _ in levels)])

    head, rest, others = _head(model, n + v + 1)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = int(size // BUCKET_BYTES) + 1
    unseen = -float(np.log10(n + v + 1))
    # Words and runs beyond the head.
    # A task marks a table of its own, so there are few.
    kept, tail = bit_table(nodes), bit_table(rest.coalesce(spark.sparkContext.defaultParallelism), n=others)
    seen = _occurrences(rows, id_type, len(levels) + 1, buckets, unseen, spark.sparkContext.broadcast(head), kept, tail)
    sums = _sums(seen, rest, id_type, buckets, n + v + 1)
    return sums.select(
        F.col("id").alias(id_col), "held_out", F.col("n").alias("n_tokens"), F.round("known").cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )
