"""Toxicity by noisy-channel restoration of words and calibrated word evidence.

Words written with digits or signs for letters, with separators inside, stretched by repetition or spaced out are
read as what the writer saw: a Viterbi search over the lattice of letters that each sign may stand for, scored by
a character model of the whole corpus and by the price of each disguise. The restored words and their starts are
counted in toxic and clean learning documents; a document's score is a logistic function of its strongest words,
fitted across two folds so that words seen once don't mislead it. Words fall into 2^20 cells by hash: beyond some hundred
thousand different words in the labelled documents cells are shared and evidence gets weaker, which is the model's limit.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import text as tx
from shelfwatch.llm.counters import count_cells, logistic, sigmoid
from shelfwatch.llm.storage import Scratch

BUCKETS = 1 << 20
# The letters that a sign is used for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
# Prices, in nats: of reading a sign as a letter, of skipping a separator, of skipping a sign that may stand for a letter
# (dearer than reading it), of skipping a repeated letter; and, of a token left as it is, of a digit and of any other sign.
SIGN, SKIP, SKIP_SIGN, REPEAT = 1.5, 1.0, 7.0, 0.5
DIGIT, OTHER = 2.5, 6.0
_CACHE = 100_000
_SPACED = re.compile(r"(?<!\w)[^\W_](?:[\W_]{1,3}[^\W_](?!\w)){2,}")
_EDGES = re.compile(r"^[^\w@$|!+(<€£¡]+|[^\w@$|€£]+$|_+$")
_THRICE = re.compile(r"(.)\1\1")


class Channel:
    """Viterbi decoder over character lattices under a model of symbol trigrams."""

    def __init__(self, counts: np.ndarray) -> None:
        """``counts`` of the 2^18 symbol trigrams of the corpus."""
        n = tx.SYMBOLS
        three = counts.reshape(n, n, n).astype(float)
        two = three.sum(axis=0)
        one = two.sum(axis=0) + 1
        p1 = one / one.sum()
        p2 = (two + 8 * p1) / (two.sum(axis=1, keepdims=True) + 8)
        p3 = (three + 8 * p2[None]) / (three.sum(axis=2, keepdims=True) + 8)
        self.price = (-np.log(p3)).astype(np.float32)

    def _plain(self, token: str) -> float:
        """Price of a token as it is: its runs of letters are words of their own, its signs are drawn one by one."""
        table, cost, a, b = tx.symbol_table(), 0.0, 0, 0
        for c in token:
            if c.isalpha():
                s = int(table[ord(c)])
                cost += float(self.price[a, b, s])
                a, b = b, s
            else:
                cost += DIGIT if c.isdigit() else OTHER if c in STANDS_FOR else SKIP
                if b:
                    cost += float(self.price[a, b, 0])
                a = b = 0
        return cost + (float(self.price[a, b, 0]) if b else 0.0)

    def restore(self, token: str) -> str:
        """The likeliest letters behind a lower-cased token; the token itself if that is likelier.

        The search is exact: a state is the last two symbols and the last letter, of which a place has a few. A path is
        a chain of letters that states share, so time and memory grow with the token's length.
        """
        table, price = tx.symbol_table(), self.price
        paths: dict[tuple[int, int, str], tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
        for c in token:
            following: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}
            alpha = c.isalpha()
            options = ((c, 0.0),) if alpha else tuple((x, SIGN) for x in STANDS_FOR.get(c, ""))
            skip = SKIP_SIGN if options else SKIP
            for state, (cost, chain) in paths.items():
                a, b, last = state
                for x, more in options:
                    s = int(table[ord(x)])
                    total, key = cost + more + float(price[a, b, s]), (b, s, x)
                    if key not in following or total < following[key][0]:
                        following[key] = (total, (x, chain))
                    if x == last:
                        # The letter once more: of one written several times.
                        again = cost + more + REPEAT
                        if state not in following or again < following[state][0]:
                            following[state] = (again, chain)
                if not alpha and (state not in following or cost + skip < following[state][0]):
                    following[state] = (cost + skip, chain)
            paths = following
        cost, chain = min(((cost + float(price[a, b, 0]), chain) for (a, b, _), (cost, chain) in paths.items()), key=lambda p: p[0])
        if chain is None or not token.isalpha() and self._plain(token) < cost:
            return token
        letters = []
        while chain is not None:
            letters.append(chain[0])
            chain = chain[1]
        return "".join(reversed(letters))


class Words:
    """Restored words of texts and their evidence cells, kept between texts."""

    def __init__(self, channel: Channel) -> None:
        self.channel = channel
        self.kept: dict[str, tuple[int, ...]] = {}

    def restored(self, token: str) -> str:
        """A token's word: plain words are as they stand, all others go through the lattice, whatever their length."""
        bare = token if token.isalpha() else _EDGES.sub("", token)
        if not bare or bare.isdigit() or bare.isalpha() and not _THRICE.search(bare):
            # A number alone is a number: nothing beside it says that its digits are letters.
            return bare
        return self.channel.restore(bare)

    def distinct(self, text: str) -> set[str]:
        """Lower-cased tokens of a text, spaced-out words being tokens as well."""
        low = text.lower()
        return set(low.split()).union(m.group() for m in _SPACED.finditer(low))

    def evidence_cells(self, token: str) -> tuple[int, ...]:
        """Cells of a token: its restored word whole, its starts of 4 to 6 bytes, its last 4 bytes."""
        word = self.restored(token).encode("utf-8", "replace")
        if not word:
            return ()
        if len(word) <= 4:
            return (crc32(word + b"$") % BUCKETS,)
        return tuple({crc32(p) % BUCKETS for p in (word + b"$", word[:4], word[:5] + b" ", word[:6] + b"  ", b"^" + word[-4:])})

    def cells(self, token: str) -> tuple[int, ...]:
        found = self.kept.get(token)
        if found is None:
            if len(self.kept) >= _CACHE:
                self.kept.clear()
            found = self.kept[token] = self.evidence_cells(token)
        return found


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of each cell for toxic against clean documents, less one standard error."""
    a, b = toxic + 0.5, clean + 0.5
    return (np.log(a / (n_toxic + 1)) - np.log(b / (n_clean + 1)) - np.sqrt(1 / a + 1 / b)).astype(np.float32)


class Scorer:
    """Document features: the strongest evidence of its three strongest tokens."""

    def __init__(self, words: Words, table: np.ndarray) -> None:
        self.words, self.table = words, array("f", table.tobytes())
        self.kept: dict[str, float] = {}

    def strongest(self, text: str) -> list[float]:
        kept, scores = self.kept, []
        for token in self.words.distinct(text):
            s = kept.get(token)
            if s is None:
                if len(kept) >= _CACHE:
                    kept.clear()
                s = kept[token] = max([self.table[c] for c in self.words.evidence_cells(token)], default=-5.0)
            scores.append(s)
        return [max(s, -5.0) for s in sorted(scores, reverse=True)[:3]] + [-5.0] * max(0, 3 - len(scores))


def _texts(batches: Iterable[pa.RecordBatch], column: int = 1):
    """``(batch, first row, texts)`` in parts of 256 rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield batch, at, [t or "" for t in batch.column(column).slice(at, 256).to_pylist()]


def character_counts(texts: DataFrame) -> np.ndarray:
    """Symbol trigrams of all texts of ``texts(id, text)``."""

    def cells(batches):
        for _, _, part in _texts(batches):
            symbols, _ = tx.symbols([t.replace("\x00", " ") for t in part])
            yield (symbols[:-2] << 12) | (symbols[1:-1] << 6) | symbols[2:]

    return count_cells(texts, tx.SYMBOLS**3, cells)


class Model:
    def __init__(self, counts: np.ndarray, table: np.ndarray, weights: np.ndarray) -> None:
        self.counts, self.table, self.weights = counts, table, weights
        self._scorer: Scorer | None = None

    def __getstate__(self):
        return self.counts, self.table, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self._scorer is None:
            self._scorer = Scorer(Words(Channel(self.counts)), self.table)
        x = np.array([self._scorer.strongest(t) for t in texts]).reshape(-1, 3)
        return sigmoid(self.weights[0] + x @ self.weights[1:])


def learn(spark: SparkSession, docs: DataFrame, labelled: DataFrame, sample: int = 20_000) -> Model:
    """Model of ``docs(id, text)`` from ``labelled(id, text, toxic)``, toxic being 0 or 1.

    Character and word counts cover all rows; the last fit reads about ``sample`` labelled rows chosen by a hash of
    the id. Without toxic or without clean rows every score is the share of toxic rows (0 without any row).
    """
    counts = character_counts(docs)
    shared = spark.sparkContext.broadcast(counts)
    scratch = Scratch(spark, "toxicity")
    rows = scratch.store(labelled.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int")), "labelled")
    sizes = np.zeros((2, 2), np.int64)
    for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect():
        sizes[r["fold"], r["toxic"]] = r["n"]
    total = sizes.sum(axis=0)
    if not total[0] or not total[1]:
        return Model(counts, np.zeros(BUCKETS, np.float32), np.array([40.0 if total[1] else -40.0, 0, 0, 0]))

    def cells(batches):
        words = Words(Channel(shared.value))
        for batch, at, texts in _texts(batches):
            kinds = zip(batch.column(3).slice(at, 256).to_pylist(), batch.column(2).slice(at, 256).to_pylist(), strict=True)
            for t, (fold, toxic) in zip(texts, kinds, strict=True):
                found: set[int] = set()
                found.update(*[words.cells(w) for w in words.distinct(t)])
                yield np.fromiter(found, np.int64, len(found)) + (2 * fold + toxic) * BUCKETS

    seen = count_cells(rows.select("id", "text", "toxic", "fold"), 4 * BUCKETS, cells).reshape(2, 2, BUCKETS)
    apart = spark.sparkContext.broadcast(
        [evidence(seen[1 - k, 1], seen[1 - k, 0], sizes[1 - k, 1], sizes[1 - k, 0]) for k in (0, 1)]
    )

    def features(batches):
        words = Words(Channel(shared.value))
        scorers = [Scorer(words, t) for t in apart.value]
        for batch, at, texts in _texts(batches):
            folds = batch.column(3).slice(at, 256).to_pylist()
            x = np.array([scorers[f].strongest(t) for f, t in zip(folds, texts, strict=True)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), batch.column(2).slice(at, 256)], names=["a", "b", "c", "toxic"])

    share = min(1.0, sample / int(total.sum()))
    chosen = rows.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) < share * (1 << 20))
    found = chosen.select("id", "text", "toxic", "fold").mapInArrow(features, "a double, b double, c double, toxic int").collect()
    x = np.array([[r["a"], r["b"], r["c"]] for r in found]).reshape(-1, 3)
    weights = logistic(x, np.array([float(r["toxic"]) for r in found]), 1e-4) if found else np.array([-3.0, 0.5, 0.1, 0.1])
    scratch.drop(rows)
    return Model(counts, evidence(*seen.sum(axis=0)[::-1], total[1], total[0]), weights)


def toxicity(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 where the score is 0.5 or more) beside each row.

    Labels are learned from rows of ``labels`` whose document satisfies ``learnable``, an expression of ``id_col``; a
    document with several labels counts once for each, null and other labels not at all. Null and empty texts
    are scored as a text without words. Rows with null or repeated ids are scored like others. Columns named
    ``score`` or ``predicted`` in ``docs`` are replaced; other columns pass through unread.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = labels.where(learnable).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("toxic IN (0, 1)")
    # Only documents that may be learned from travel to their labels.
    apart = docs.where(learnable).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = spark.sparkContext.broadcast(learn(spark, texts, apart.join(marks.hint("merge"), "id").select("id", "text", "toxic")))
    kept = docs.drop("score", "predicted")
    names = [*kept.columns, "score", "predicted"]
    at_text = kept.columns.index(text_col)

    def score(batches):
        for batch, at, part in _texts(batches, at_text):
            s = model.value.scores(part)
            columns = [c.slice(at, 256) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(score, f"{schema}, score double, predicted int")
