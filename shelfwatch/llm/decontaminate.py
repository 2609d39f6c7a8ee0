"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits in lower case. A test item's seeds are its distinct runs of three words. One pass
over all documents counts in how many each seed occurs; an item's rare seeds are those no more frequent than its
median seed, so an item that was copied very often keeps seeds as well. A second pass meets documents and items in
rare seeds: a stretch of a document with two distinct ones of an item (one, where an item has fewer than four) is
aligned with the item word by word (match +1, mismatch and gap -1), which finds copies with words changed,
dropped or put in.

Both passes read whole texts and shuffle nothing but counters. The items are the stated query set: they are taken in
blocks of a bounded number of words, and each block is sent to the tasks and held against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwatch.llm import text as tx
from shelfwatch.llm.counters import count_cells

SEED = 3
BLOCK_WORDS = 1 << 20


@dataclass
class Block:
    """Some items: their ids and word hashes, and their seeds, ascending, with the items each is rare in."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    owners: list[np.ndarray]  # by seed

    def rare(self, counts: np.ndarray) -> Block:
        """The block with each seed's owners cut to the items in which it is rare."""
        held: list[list[int]] = [[] for _ in self.ids]
        for k, owners in enumerate(self.owners):
            for item in owners:
                held[item].append(k)
        limits = [np.median(counts[h]) if h else 0 for h in held]
        owners = [np.array([i for i in o if counts[k] <= limits[i]], np.int64) for k, o in enumerate(self.owners)]
        keep = [k for k, o in enumerate(owners) if len(o)]
        return Block(self.ids, self.words, self.seeds[keep], [owners[k] for k in keep])


def _row_words(column: pa.Array) -> Iterator[np.ndarray]:
    for at, to, raw, bounds in tx.slices(column):
        hashes, rows, _, _ = tx.words(raw, bounds, tx.PUNCTUATION)
        cuts = np.searchsorted(rows, np.arange(to - at + 1))
        for k in range(to - at):
            yield hashes[cuts[k] : cuts[k + 1]]


def _blocks(items: DataFrame, block_words: int) -> Iterator[Block]:
    """The items in blocks of about ``block_words`` words, an item being whole in one."""
    # A word has a letter and a separator at least.
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + int(size) // (2 * block_words)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        words = list(_row_words(pa.array([r["text"] for r in rows], pa.string())))
        owners: dict[int, list[int]] = {}
        for item, w in enumerate(words):
            if len(w) >= SEED:
                for seed in np.unique(tx.runs(w, SEED)).tolist():
                    owners.setdefault(seed, []).append(item)
        seeds = np.array(sorted(owners), np.uint64)
        if len(seeds):
            yield Block([r["id"] for r in rows], words, seeds, [np.array(owners[s]) for s in seeds.tolist()])


def _hits(block: Block, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a document, and the seeds found there."""
    if len(words) < SEED:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = tx.runs(words, SEED)
    place = np.minimum(np.searchsorted(block.seeds, found), len(block.seeds) - 1)
    at = np.flatnonzero(block.seeds[place] == found)
    return at, place[at]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two word sequences, and where in ``text`` the alignment ends (exclusive)."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(text == w, 1, -1), row[1:] - 1)
        # A gap in the item is a run along the row, each step of which costs one.
        row = np.maximum(np.maximum.accumulate(new + steps) - steps, 0)
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def leaks(block: Block, words: np.ndarray, share: float, least: int) -> list[tuple]:
    """``(item number, score, first word, word after the last)`` of a document's best alignment with each leaked item."""
    at, seeds = _hits(block, words)
    if not len(at):
        return []
    by_item: dict[int, list[tuple[int, int]]] = {}
    for place, seed in zip(at.tolist(), seeds.tolist(), strict=True):
        for item in block.owners[seed].tolist():
            by_item.setdefault(item, []).append((place, seed))
    out = []
    for item, hits in by_item.items():
        words_of = block.words[item]
        n, best = len(words_of), (0, 0, 0)
        groups, last = [[hits[0]]], hits[0][0]
        for hit in hits[1:]:
            if hit[0] - last > 2 * n:
                groups.append([])
            groups[-1].append(hit)
            last = hit[0]
        for group in groups:
            if len({seed for _, seed in group}) < (2 if n >= SEED + 3 else 1):
                continue
            first = max(0, group[0][0] - 2 * n)
            window = words[first : group[-1][0] + 2 * n]
            score, end = align(words_of, window)
            if score > best[0]:
                best = score, first, end
        score, first, end = best
        if score >= least and score >= share * n or score >= n > 0:
            back, length = align(words_of[::-1], words[first : first + end][::-1])
            out.append((item, score, first + end - length, first + end))
    return out


def _prepared(
    spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, block_words: int
):
    """Broadcast blocks with their rare seeds."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    named = items.select(F.col(item_col).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    for block in _blocks(named, block_words):
        sent = spark.sparkContext.broadcast(block)

        def cells(batches, sent=sent):
            for batch in batches:
                for words in _row_words(batch.column(1)):
                    yield np.unique(_hits(sent.value, words)[1])

        counts = count_cells(texts, -(-len(block.seeds) // 64) * 64, cells)
        yield spark.sparkContext.broadcast(block.rare(counts))


def find_leaks(
    spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", share: float = 0.5, least: int = 6, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(id_col, item_col, score, item_words, first_word, end_word)`` for every document row and item it leaks.

    An item leaks where an alignment scores at least ``share`` of its words and at least ``least``, or all its words. Items
    of fewer than three words, null and empty texts leak nothing. Repeated documents or items give rows
    each; null ids are kept. Word places count letter-digit runs from 0. Other columns are not read. Where both id
    columns have one name, the item's comes out as ``item_`` and that name.
    """
    item_type = items.schema[item_col].dataType
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (
        f"id {texts.schema['id'].dataType.simpleString()}, item {item_type.simpleString()}, score bigint, item_words bigint, "
        "first_word bigint, end_word bigint"
    )
    arrow_item = to_arrow_type(item_type)
    found = spark.createDataFrame([], schema)
    for sent in _prepared(spark, docs, items, id_col, text_col, item_col, item_text, block_words):

        def search(batches, sent=sent):
            block = sent.value
            for batch in batches:
                rows, out = [], []
                for k, words in enumerate(_row_words(batch.column(1))):
                    for item, *rest in leaks(block, words, share, least):
                        rows.append(k)
                        out.append((block.ids[item], rest[0], len(block.words[item]), *rest[1:]))
                columns = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], arrow_item), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                    names=["id", "item", "score", "item_words", "first_word", "end_word"],
                )

        found = found.union(texts.mapInArrow(search, schema))
    return found.toDF(id_col, item_col if item_col != id_col else f"item_{item_col}", *found.columns[2:])


def drop_leaks(
    spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", share: float = 0.5, least: int = 6, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns unchanged; see ``find_leaks``."""
    place = docs.columns.index(text_col)
    kept = docs
    for sent in _prepared(spark, docs, items, id_col, text_col, item_col, item_text, block_words):

        def clean(batches, sent=sent):
            for batch in batches:
                keep = [not leaks(sent.value, words, share, least) for words in _row_words(batch.column(place))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
