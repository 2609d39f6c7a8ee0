"""Target-distribution importance resampling, drawn by parallel sorting by regular sampling.

Features are hashed to buckets; a bucket's gain compares its share of the target texts with its share of all
documents, and arrays of gains score whole texts at once. A document's weight plus Gumbel noise of its id is
its score, and the highest scores are a draw without replacement. Exact ranks come from parallel sorting by regular
sampling: every task writes its scores as a sorted run; rows at regular places of the runs give regular splitters;
the segments between splitters are exchanged and merged in order; and the segments' counts, summed before each, turn a
place in a segment into a rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import text as tx
from shelfwatch.llm.counters import count_cells
from shelfwatch.llm.storage import Scratch

BUCKETS = 10_000
# Regular samples that the driver sorts at most; more runs than this allows make segments less even, never wrong.
SAMPLES = 1 << 20
# Words up to so many bytes go through the shift tables.
SHORT = 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_CRC = _crc_table()


def _shift_tables() -> np.ndarray:
    """``[n, k, b]``: what byte ``k`` of a checksum, having value ``b``, is after ``n`` further zero bytes."""
    one = np.array([[b << 8 * k for b in range(256)] for k in range(4)], np.uint32)
    tables = [one]
    for _ in range(SHORT):
        one = (one >> np.uint32(8)) ^ _CRC[one & np.uint32(255)]
        tables.append(one)
    return np.array(tables)


_SHIFT = _shift_tables()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _append(head: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums of joined strings from those of their halves; the second halves have ``size`` bytes."""
    out = tail.copy()
    for k in range(4):
        out ^= _SHIFT[size, k, (head >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def features(raw: np.ndarray, bounds: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature of a slice of texts, and the number of words of each row."""
    low = _LOWER[raw]
    _, row, start, end = tx.words(low, bounds, tx.PUNCTUATION)
    counts = np.bincount(row, minlength=len(bounds) - 1)
    if not len(row):
        return row, row, counts
    size = end - start
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    short = np.flatnonzero(size <= SHORT)
    for j in range(int(size[short].max(initial=0))):
        short = short[size[short] > j]
        state[short] = _CRC[(state[short] ^ low[start[short] + j]) & np.uint32(255)] ^ (state[short] >> np.uint32(8))
    crc = ~state
    long = np.flatnonzero(size > SHORT)
    for k in long.tolist():
        crc[k] = zlib.crc32(low[start[k] : end[k]])
    # A pair is the first word, a space and the second word.
    first = np.flatnonzero(row[1:] == row[:-1])
    spaced = ~(_CRC[(~crc[first] ^ np.uint32(32)) & np.uint32(255)] ^ (~crc[first] >> np.uint32(8)))
    second = first + 1
    pair = _append(spaced, crc[second], np.minimum(size[second], SHORT))
    for k in np.flatnonzero(size[second] > SHORT).tolist():
        w = second[k]
        pair[k] = zlib.crc32(low[start[w] : end[w]], int(spaced[k]))
    return np.r_[row, row[first]], np.r_[crc, pair].astype(np.int64) % buckets, counts


def _bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of each bucket in all texts of the column ``text``."""

    def cells(batches):
        for batch in batches:
            for _, _, raw, bounds in tx.slices(batch.column(0)):
                yield features(raw, bounds, buckets)[1]

    return count_cells(texts.select("text"), -(-buckets // 64) * 64, cells)[:buckets]


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of a bucket's smoothed shares."""
    n, total, wanted = len(documents), int(documents.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (total + n) / ((s + 1) * (wanted + n))))
            for s, t in zip(documents.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(key: object, seed: int) -> int:
    """Floored thousandths of Gumbel noise of an id."""
    h = int(hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(docs: DataFrame, id_type: str, gain: np.ndarray, least_words: int, seed: int) -> DataFrame:
    names = ["id", "n_features", "weight", "score", "eligible"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, raw, bounds in tx.slices(batch.column(1)):
                row, bucket, words = features(raw, bounds, len(gain))
                n = np.bincount(row, minlength=to - at)
                # Integers add up exactly in doubles here: a text has far fewer than 2^53 / 20,000 features.
                total = np.bincount(row, gain[bucket], to - at).astype(np.int64)
                weight = total // np.maximum(n, 1)
                ids = batch.column(0).slice(at, to - at)
                score = weight + np.array([noise(k, seed) for k in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(weight), pa.array(score), pa.array(words >= least_words)], names=names)

    return docs.mapInArrow(rows, f"id {id_type}, n_features bigint, weight bigint, score bigint, eligible boolean")


def regular_ranks(spark: SparkSession, scratch: Scratch, rows: DataFrame, segments: int | None = None) -> DataFrame:
    """``rows(id, score, ...)`` with ``rank``: 1 for the highest score, ties to the smaller id, null ids last.

    Rows that agree in both are told apart by run and place, so a group of equal rows is split between segments like
    any other rows. A segment holds at most about N / segments + runs * N / samples of the N rows.
    """
    columns = rows.columns
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # The place is that of the row in its run, once and for all: it is written with the run.
    runs = scratch.store(rows.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "runs")
    at = F.col("place").bitwiseAND((1 << 33) - 1)
    total, n_runs = runs.agg(F.count("*"), F.count_distinct(F.shiftright("place", 33))).first()
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    samples = max(1, min(SAMPLES, segments * max(n_runs, 1)))
    step = max(1, total // samples)
    sampled = runs.where(at % step == step // 2).select("id", "score", "place").collect()
    key = lambda identity, score, place: (-score, identity is None, identity if identity is not None else 0, place)
    regular = sorted(key(*r) for r in sampled)
    splitters = [regular[len(regular) * k // segments] for k in range(1, segments)] if regular else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_left(splitters, key(*r)) for r in zip(*(batch.column(c).to_pylist() for c in ("id", "score", "place")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names=[*batch.schema.names, "segment"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema.fields)
    exchanged = runs.mapInArrow(cut, f"{schema}, segment int").repartitionById(segments, F.col("segment"))
    merged = exchanged.sortWithinPartitions(*order, "place").withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    merged = scratch.store(merged, "segments")
    scratch.drop(runs)
    sizes = {r["segment"]: r["n"] for r in merged.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    before = np.cumsum([0, *[sizes.get(k, 0) for k in range(segments)]]).tolist()
    ahead = spark.createDataFrame(list(enumerate(before[:segments])), "segment int, ahead bigint")
    ranked = merged.join(F.broadcast(ahead), "segment")
    return ranked.select(*columns, (F.col("ahead") + F.col("at") + 1).alias("rank"))


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_text: str = "text", percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS,
) -> DataFrame:
    """``(id_col, n_features, weight, score, rank)`` of every row of ``docs``; undrawn rows have a null rank.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased; features are
    words and pairs of neighbouring words. A null or empty text has none and weight 0. Of the rows with at least
    ``least_words`` words the floored ``percent`` with the highest scores are drawn. Null ids are hashed as ``null`` and
    lose ties; repeated rows are drawn one by one. An empty target gives every bucket the same target count; an empty
    table gives no rows. Other columns are not read.
    """
    scratch = Scratch(spark, "resample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    gain = gains(_bucket_counts(texts, buckets), _bucket_counts(target.select(F.col(target_text).alias("text")), buckets))
    scored = scratch.store(_scored(texts, id_type, gain, least_words, seed), "scored")
    eligible = scored.where("eligible").drop("eligible")
    drawn = eligible.count() * percent // 100
    ranked = regular_ranks(spark, scratch, eligible).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where("NOT eligible").drop("eligible").withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(others).withColumnRenamed("id", id_col)
