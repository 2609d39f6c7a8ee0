"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

Letters map to 64 symbols (a-z one each, others hashed, everything else a boundary), so the n-grams of order 3 are
at most 2^18 keys a language. Counts of all learning rows come from one distributed pass; the models are sorted key
arrays with log probabilities, a few MB whatever the input, and are broadcast. The language with the lowest
cross-entropy per symbol wins; a logistic fit on how far it leads gives the confidence and the rejection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import text as tx
from shelfwatch.llm.counters import count_cells, logistic, sigmoid

ORDER = 3
KEYS = tx.SYMBOLS**ORDER
UNKNOWN = "und"
_CHUNK = 1 << 18


def _keys(symbols: np.ndarray) -> np.ndarray:
    """Key of the n-gram that ends at each symbol from the third on."""
    return (symbols[:-2] << 12) | (symbols[1:-1] << 6) | symbols[2:]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at, held, size = 0, [], 0
    for k, t in enumerate(texts):
        held.append((t or "").replace("\x00", " "))
        size += len(held[-1])
        if size > _CHUNK:
            yield at, held
            at, held, size = k + 1, [], 0
    if held:
        yield at, held


class KneserNey:
    """One language's interpolated Kneser-Ney model over n-gram keys of six bits a symbol."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """``keys`` ascending and distinct, of order 3, with their counts."""
        levels, order = [], ORDER
        counts = counts.astype(float)
        while True:
            levels.append((order, keys, counts))
            if order == 1:
                break
            order -= 1
            # Below the top an n-gram counts once for every symbol that was seen before it.
            keys, counts = np.unique(keys & ((1 << 6 * order) - 1), return_counts=True)
            counts = counts.astype(float)
        self.levels = []
        for order, keys, counts in reversed(levels):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            heads, first = np.unique(keys >> 6, return_index=True)
            total = np.add.reduceat(counts, first)
            kinds = np.diff(np.r_[first, len(keys)])
            spread = discount * kinds / total
            place = np.searchsorted(heads, keys >> 6)
            below = self._below(keys, order)
            self.levels.append((keys, np.maximum(counts - discount, 0) / total[place] + spread[place] * below, heads, spread))

    def _below(self, keys: np.ndarray, order: int) -> np.ndarray:
        return self.probability(keys & ((1 << 6 * (order - 1)) - 1), order - 1) if order > 1 else np.full(len(keys), 1 / tx.SYMBOLS)

    def probability(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of each n-gram's last symbol after the others, seen or not."""
        known, probability, heads, spread = self.levels[order - 1]
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        seen = known[place] == keys
        out = probability[place]
        if not seen.all():
            rest = keys[~seen]
            at = np.minimum(np.searchsorted(heads, rest >> 6), len(heads) - 1)
            out[~seen] = np.where(heads[at] == rest >> 6, spread[at], 1.0) * self._below(rest, order)
        return out


class Models:
    """The languages' models over one sorted array of all keys that any of them has seen."""

    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        """``counts``: a row of ``KEYS`` counters for each of ``langs``; a language without counts is dropped."""
        full = [k for k in range(len(langs)) if counts[k].any()]
        self.langs = [langs[k] for k in full]
        self.each = [KneserNey(np.flatnonzero(counts[k]), counts[k][counts[k] > 0]) for k in full]
        self.keys = np.flatnonzero(counts[full].any(axis=0))
        self.logs = np.column_stack([np.log2(m.probability(self.keys)) for m in self.each]) if full else np.zeros((0, 0))
        self.weights = np.array([-1.0, 8.0, 0.3])

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol under each language, and the number of symbols, of every text."""
        symbols, ends = tx.symbols(texts)
        keys = _keys(symbols)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        logs = self.logs[place]
        unseen = np.flatnonzero(self.keys[place] != keys)
        if len(unseen):
            logs[unseen] = np.column_stack([np.log2(m.probability(keys[unseen])) for m in self.each])
        sums = np.vstack([np.zeros((1, len(self.each))), np.cumsum(logs, axis=0)])
        first, last = ends[:-1], np.maximum(ends[1:] - 1, ends[:-1])
        first, last = np.minimum(first, len(keys)), np.minimum(last, len(keys))
        n = last - first
        return -(sums[last] - sums[first]) / np.maximum(n, 1)[:, None], np.where(np.diff(ends) > 1, n, 0)

    def features(self, entropies: np.ndarray, n: np.ndarray) -> np.ndarray:
        ranked = np.sort(entropies, axis=1)
        lead = ranked[:, 1] - ranked[:, 0] if ranked.shape[1] > 1 else np.ones(len(ranked))
        return np.column_stack([lead, np.log1p(n) / 5])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and confidence of every text."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        entropies, n = self.entropies(texts)
        best = entropies.argmin(axis=1)
        lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        score = sigmoid(self.weights[0] + self.features(entropies, n) @ self.weights[1:])
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, lettered, strict=True)], np.where(lettered, score, 0.0)


def learn(spark: SparkSession, rows: DataFrame, sample: int = 20_000) -> Models:
    """Models of the non-null ``lang`` values of ``rows(id, text, lang)``.

    Counts cover all rows. The confidence is fitted on about ``sample`` rows, a fifth of all at most, chosen by a hash
    of the id, under models that haven't counted them; their counts are added afterwards.
    """
    rows = rows.where("lang IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Models([], np.zeros((0, KEYS), np.int64))
    number = {lang: k for k, lang in enumerate(langs)}

    def cells(batches):
        for batch in batches:
            names = batch.column(2).to_pylist()
            for at, texts in _chunks(batch.column(1).to_pylist()):
                symbols, ends = tx.symbols(texts)
                owner = np.repeat([number[x] for x in names[at : at + len(texts)]], np.diff(ends))
                n = len(symbols) - 2
                inside = np.ones(max(n, 0), bool)
                inside[ends[1:-1] - 1] = False  # an n-gram over the end of a text
                yield (_keys(symbols) + owner[:n] * KEYS)[inside]

    share = min(0.2, sample / sum(totals.values()))
    apart = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20))
    counted = [count_cells(r.select("id", "text", "lang"), KEYS * len(langs), cells).reshape(-1, KEYS) for r in (rows.where(~apart), rows.where(apart))]
    models = Models(langs, counted[0])
    known = spark.sparkContext.broadcast(models)

    def margins(batches):
        for batch in batches:
            m, names = known.value, batch.column(2).to_pylist()
            for at, texts in _chunks(batch.column(1).to_pylist()):
                entropies, n = m.entropies(texts)
                right = [m.langs[b] == x for b, x in zip(entropies.argmin(axis=1), names[at : at + len(texts)], strict=True)]
                f = m.features(entropies, n)
                yield pa.RecordBatch.from_arrays([pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array(right)], names=["a", "b", "ok"])

    seen = rows.where(apart).select("id", "text", "lang").mapInArrow(margins, "a double, b double, ok boolean").collect() if models.langs else []
    models = Models(langs, counted[0] + counted[1])
    if seen:
        models.weights = logistic(np.array([[r["a"], r["b"]] for r in seen]), np.array([float(r["ok"]) for r in seen]), 1e-5)
    return models


def identify(
    spark: SparkSession, docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", reject_below: float = 0.5,
) -> DataFrame:
    """``(id_col, lang_pred, score, rejected)`` of every row of ``docs``, learning where ``learnable`` holds.

    ``score`` is the calibrated probability that the language is right; ``rejected`` marks rows below
    ``reject_below``. A null text or one without letters is ``und`` with score 0 and rejected, as is every text when
    nothing could be learned. Rows with null or repeated ids are scored like others. A null ``lang``
    teaches nothing; ``lang`` and the id are not read for predictions. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), learnable.alias("learnable"))
    models = spark.sparkContext.broadcast(learn(spark, rows.where("learnable").drop("learnable")))

    def predict(batches):
        for batch in batches:
            for at, texts in _chunks(batch.column(1).to_pylist()):
                langs, score = models.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(langs), pa.array(score), pa.array(score < reject_below)],
                    names=["id", "lang_pred", "score", "rejected"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    return (
        rows.select("id", "text").mapInArrow(predict, f"id {id_type}, lang_pred string, score double, rejected boolean")
        .withColumnRenamed("id", id_col)
    )
