"""N-gram Jaccard join with components, skipping by set relations.

A document's set holds its distinct word shingles. Sets are ordered by how common a shingle is (counts in
2^22 hashed cells, a fixed size whatever the corpus), and only the head of a set that any partner must share
is indexed, with positions (prefix and position filters).

Set relations save the rest:

* Equal sets are one vertex.
* Near copies meet under four minimum hashes; each group checks its members against one leader, in linear
  work. Vertices that these links join have one answer: in the index a list keeps **one block per group**,
  with the bounds of its sizes and positions. A pair of blocks is skipped as a whole where the bounds exclude
  every pair, and a list with one block is never walked. Only blocks that remain are opened.
* What remains is checked on the whole sets, so no link between different groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import text as tx
from shelfwatch.llm.components import components
from shelfwatch.llm.counters import bit_table, count_cells, has_bit
from shelfwatch.llm.storage import Scratch

# Pairs of one vertex that one task checks; the more, the fewer copies of its set travel.
DEALT = 128
CELLS = 1 << 22
# Bits for each wanted id, and of a whole table: more ids only mean more sets that no pair needs.
KEY_BITS, MOST_BITS = 64, 1 << 27
# Cells of the marks that bound what two sets share.
MARKS = 1 << 12
_KEYS = (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple]:
    """``(batch, row, shingle hashes)`` of every row of ``(id, text)`` batches."""
    for batch in batches:
        for at, to, raw, bounds in tx.slices(batch.column(1)):
            hashes, rows, _, _ = tx.words(raw, bounds)
            cuts = np.searchsorted(rows, np.arange(to - at + 1))
            for k in range(to - at):
                yield batch, at + k, tx.shingles(hashes[cuts[k] : cuts[k + 1]], words)


def _commonness(docs: DataFrame, words: int) -> np.ndarray:
    """Per cell, how many powers of two its count lies above what chance explains; 0 for ordinary cells.

    Tasks count into a fixed table and send it in compressed parts; the driver gets 2^22 counters.
    """

    def cells(batches):
        for _, _, s in _sets(batches, words):
            yield (s & np.uint64(CELLS - 1)).astype(np.int64)

    counts = count_cells(docs, CELLS, cells)
    # Chance alone spreads the counts of ordinary cells about their mean by its square root.
    noise = 4 * np.sqrt(max(1.0, counts.mean()))
    above = (counts - counts.mean()) / noise
    return np.where(above > 1, np.clip(np.floor(np.log2(np.maximum(above, 1))) + 1, 0, 31), 0).astype(np.uint8)


def _ordered(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Shingles as 64-bit ranks: commonness in the upper bits, 58 bits of hash below; sorted."""
    ranks = (hashes >> np.uint64(6)) | (common[(hashes & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58))
    ranks.sort()
    return ranks


def _identity(ranks: np.ndarray) -> int:
    """The set's vertex id: a sum that no order changes, 64 bits."""
    total = np.add.reduce(tx.mix(ranks ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(ranks))
    return int(tx.signed(tx.mix(np.array([total], np.uint64)))[0])


def _features(docs: DataFrame, id_type: str, words: int, percent: int, common) -> DataFrame:
    def rows(batches):
        # One output batch per some input rows, so that long texts don't pile up.
        def flush(ids, sizes, sigs, keys, heads):
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(ids), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0] + [len(h) for h in heads]), pa.int32()),
                        pa.array(tx.signed(np.concatenate(heads)) if heads else [], pa.int64()),
                    ),
                ],
                names=["id", "n", "vertex", "keys", "head"],
            )

        ids, sizes, sigs, keys, heads, held = [], [], [], [], [], 0
        for batch, row, s in _sets(batches, words):
            ids.append(batch.column(0).slice(row, 1))
            n = len(s)
            sizes.append(n)
            if n:
                ranks = _ordered(s, common.value)
                sigs.append(_identity(ranks))
                keys.append([int(tx.signed(np.min(tx.mix(ranks * np.uint64(k)), keepdims=True))[0]) for k in _KEYS])
                heads.append(ranks[: n - (percent * n + 99) // 100 + 1])
            else:
                sigs.append(None)
                keys.append([])
                heads.append(np.zeros(0, np.uint64))
            held += len(heads[-1]) + 8
            if held > 1 << 18:
                yield flush(ids, sizes, sigs, keys, heads)
                ids, sizes, sigs, keys, heads, held = [], [], [], [], [], 0
        if ids:
            yield flush(ids, sizes, sigs, keys, heads)

    return docs.mapInArrow(rows, f"id {id_type}, n bigint, vertex bigint, keys array<bigint>, head array<bigint>")


def _whole_sets(docs: DataFrame, words: int, common, wanted) -> DataFrame:
    """``(vertex, items)`` of the rows ``(key, text)`` whose key may be in the bit table ``wanted``."""

    def rows(batches):
        sigs, sets, held = [], [], 0
        for ranks in _wanted_sets(batches, words, common, wanted):
            sigs.append(_identity(ranks))
            sets.append(ranks)
            held += len(ranks)
            if held > 1 << 18:
                yield _lists(sigs, sets, "items")
                sigs, sets, held = [], [], 0
        if sigs:
            yield _lists(sigs, sets, "items")

    return docs.mapInArrow(rows, "vertex bigint, items array<bigint>")


def _marks(docs: DataFrame, words: int, common, wanted) -> DataFrame:
    """``(vertex, size, marks)`` of the same rows: how many items, and a bit for each of ``MARKS`` cells that holds one."""

    def rows(batches):
        sigs, sizes, marks = [], [], []
        for ranks in _wanted_sets(batches, words, common, wanted):
            bits = np.zeros(MARKS, bool)
            bits[(ranks & np.uint64(MARKS - 1)).astype(np.int64)] = True
            sigs.append(_identity(ranks))
            sizes.append(len(ranks))
            marks.append(np.packbits(bits).view(np.uint64))
            if len(sigs) >= 1 << 12:
                yield _lists(sigs, marks, "marks").append_column("size", pa.array(sizes, pa.int64()))
                sigs, sizes, marks = [], [], []
        if sigs:
            yield _lists(sigs, marks, "marks").append_column("size", pa.array(sizes, pa.int64()))

    return docs.mapInArrow(rows, "vertex bigint, marks array<bigint>, size bigint")


def _wanted_sets(batches, words: int, common, wanted) -> Iterator[np.ndarray]:
    """The ordered sets, of one item at least, of the rows whose key may be in the bit table ``wanted``."""
    chosen = (b.filter(pa.array(has_bit(wanted.value, b.column(0).to_numpy().view(np.uint64)))) for b in batches)
    return (_ordered(s, common.value) for _, _, s in _sets(chosen, words) if len(s))


def _lists(sigs: list[int], lists: list[np.ndarray], name: str) -> pa.RecordBatch:
    bounds = pa.array(np.cumsum([0] + [len(v) for v in lists]), pa.int32())
    column = pa.ListArray.from_arrays(bounds, pa.array(tx.signed(np.concatenate(lists)), pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), column], names=["vertex", name])


def _similar_size(percent: int, a: str, b: str) -> str:
    return f"100 * {a} >= {percent} * {b} AND 100 * {b} >= {percent} * {a}"


def _checked(
    scratch: Scratch, pairs: DataFrame, docs: DataFrame, owners: DataFrame, words: int, percent: int, common
) -> DataFrame:
    """Of ``pairs(a, b)``, those whose whole sets link, as a written table.

    Cells that hold items of one set only bound what both share, which settles most pairs that don't link; the whole sets
    of the others are compared. Texts don't travel: a bit table of the ids of vertices in pairs says which to read."""
    texts = docs.select(F.xxhash64("id").alias("key"), "text")

    def read(make, pairs: DataFrame, name: str) -> DataFrame:
        needed = pairs.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
        ids = scratch.store(owners.join(needed, "vertex", "left_semi").select(F.xxhash64("id").alias("key")).distinct(), "ids")
        found = make(texts, words, common, bit_table(ids, KEY_BITS, most=MOST_BITS)).dropDuplicates(["vertex"])
        found = scratch.store(found, name)
        scratch.drop(ids)
        return found

    def sides(pairs: DataFrame, table: DataFrame) -> DataFrame:
        return _with_columns(_with_columns(pairs, table, _hot(pairs, "a"), "a", "b"), table, _hot(pairs, "b"), "b", "a")

    def linked(both: Column, shared: Column) -> Column:
        return 100 * shared >= percent * (both - shared)

    marks = read(_marks, pairs, "marks")
    apart = F.aggregate(F.zip_with("a_marks", "b_marks", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, k: n + k)
    both = F.col("a_size") + F.col("b_size")
    # Each cell of one set only holds an item that is not shared.
    open_pairs = sides(pairs, marks).where(linked(both, F.floor((both - apart) / 2))).select("a", "b")
    open_pairs = scratch.store(open_pairs, "open")
    scratch.drop(marks)

    sets = read(_whole_sets, open_pairs, "sets")
    shared = F.size(F.array_intersect("a_items", "b_items")).cast("bigint")
    links = sides(open_pairs, sets).where(linked(F.size("a_items") + F.size("b_items"), shared)).select("a", "b")
    links = scratch.store(links, "checked")
    scratch.drop(sets, open_pairs)
    return links


def _hot(pairs: DataFrame, side: str) -> DataFrame:
    """Vertices of many pairs on one side, and how many parts of about ``DEALT`` these make."""
    many = pairs.groupBy(side).agg(F.count("*").alias("met")).where(F.col("met") > DEALT)
    return many.select(F.col(side).alias("hot"), F.ceil(F.col("met") / DEALT).cast("int").alias("parts"))


def _with_columns(pairs: DataFrame, table: DataFrame, many: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with the columns of ``table(vertex, ...)`` for one side. A vertex of many pairs, such as a leader, has
    them dealt over several tasks, which get a copy of its row each."""
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(other), F.col("parts")).cast("int"))
    dealt = pairs.join(many, F.col(side) == F.col("hot"), "left").withColumn("part", part).drop("hot", "parts")
    copies = table.join(many, F.col("vertex") == F.col("hot"), "left").select(
        F.col("vertex").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in table.columns if c != "vertex"],
        F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
    )
    return dealt.join(copies, [side, "part"]).drop("part")


def jaccard_components(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = 4, percent: int = 85,
) -> DataFrame:
    """``(id_col, n_shingles, component_id)``, one row per row of ``docs``.

    Two rows link when 100 * shared shingles >= ``percent`` * all their shingles. ``component_id`` is the smallest
    id reachable by links. Null and empty texts have no shingles and link with nothing; a text shorter than
    ``words`` words is one shingle. Rows with a null id take part and get the smallest id of their component, null
    if it has none. Repeated rows stay, each with its result. Other columns of ``docs`` are not read, whatever
    their names. Sets are told apart by 64-bit hashes of their 58-bit shingle hashes.
    """
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    common = spark.sparkContext.broadcast(_commonness(docs, words))
    features = scratch.store(_features(docs, id_type, words, percent, common), "features")
    vertices = scratch.store(
        features.where("n > 0").groupBy("vertex").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"),
            *[F.first(c).alias(c) for c in ("n", "keys", "head")],
        ),
        "vertices",
    )
    owners = vertices.select("vertex", "id")
    rows = scratch.store(features.select("id", "n", "vertex"), "rows")
    scratch.drop(features)

    # Leaders of near copies. The text with the most copies is the likeliest source of the edited ones; where none
    # stands out, every key has a leader of its own, since two edited copies are further apart than each is from the source.
    met = vertices.select("vertex", "n", "copies", F.posexplode("keys").alias("k", "key"))
    order = F.struct("copies", F.xxhash64("vertex", "k").alias("turn"))
    leaders = met.groupBy("k", "key").agg(F.max_by(F.struct("vertex", "n"), order).alias("leader"))
    led = (
        met.join(leaders, ["k", "key"]).where("vertex <> leader.vertex").where(_similar_size(percent, "n", "leader.n"))
        .select(F.col("leader.vertex").alias("a"), F.col("vertex").alias("b")).distinct()
    )
    led = scratch.store(led, "led")
    near = _checked(scratch, led, docs, owners, words, percent, common)
    groups = scratch.store(components(spark, near), "groups").select(
        F.col("node").alias("vertex"), F.col("root").alias("grp")
    )

    # One block per list and group; a vertex outside groups is a block of its own.
    placed = vertices.join(groups, "vertex", "left").select(
        "vertex", "n", F.coalesce("grp", "vertex").alias("grp"), F.col("grp").isNotNull().alias("many"),
        F.posexplode("head").alias("pos", "item"),
    ).withColumn("rest", F.col("n") - F.col("pos"))
    alone = placed.where("NOT many").selectExpr("item", "grp", "n AS low", "n AS high", "rest", "false AS many")
    members = scratch.store(placed.where("many").select("item", "grp", "vertex", "n", "rest"), "members")
    blocks = alone.union(
        members.groupBy("item", "grp")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest"))
        .select("item", "grp", "low", "high", "rest", F.lit(True).alias("many"))
    )
    left = blocks.select(*[F.col(c).alias(f"a_{c}") if c != "item" else F.col(c) for c in blocks.columns])
    right = blocks.select(*[F.col(c).alias(f"b_{c}") if c != "item" else F.col(c) for c in blocks.columns])
    open_blocks = left.join(right, "item").where(
        f"a_grp < b_grp AND 100 * a_high >= {percent} * b_low AND 100 * b_high >= {percent} * a_low "
        f"AND least(a_rest, b_rest) * {100 + percent} >= {percent} * (a_low + b_low)"
    )
    open_blocks = scratch.store(
        open_blocks.select("item", *[f"{s}_{c}" for s in "ab" for c in ("grp", "low", "rest", "many")]), "blocks"
    )

    def opened(frame: DataFrame, side: str) -> DataFrame:
        inside = members.select(
            "item", F.col("grp").alias(f"{side}_grp"), F.col("vertex").alias(side), F.col("n").alias(f"{side}_n"),
            F.col("rest").alias(f"{side}_left"),
        )
        single = frame.where(f"NOT {side}_many").select(
            "*", F.col(f"{side}_grp").alias(side), F.col(f"{side}_low").alias(f"{side}_n"),
            F.col(f"{side}_rest").alias(f"{side}_left"),
        )
        many = frame.where(f"{side}_many").join(inside, ["item", f"{side}_grp"])
        return single.unionByName(many.select(*single.columns))

    candidates = opened(opened(open_blocks, "a"), "b").where(
        f"{_similar_size(percent, 'a_n', 'b_n')} AND least(a_left, b_left) * {100 + percent} >= {percent} * (a_n + b_n)"
    ).select("a", "b").distinct()
    candidates = scratch.store(candidates, "candidates")
    scratch.drop(open_blocks, members)
    rest = _checked(scratch, candidates, docs, owners, words, percent, common)
    roots = components(spark, scratch.store(near.union(rest), "links"))

    known = owners.join(roots, owners.vertex == roots.node, "left").select(
        "vertex", F.coalesce("root", "vertex").alias("root"), "id"
    )
    named = known.join(known.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("vertex", "component_id")
    return rows.join(named, "vertex", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("vertex").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
