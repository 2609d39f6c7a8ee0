"""One row per key.

``row_number() = 1`` is planned with a group limit below the exchange: every map task keeps one row per key,
so a key that holds a third of all rows sends one row per task, not the third.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (), total: bool = False
) -> DataFrame:
    """First row of each key by ``order``.

    Unless ``order`` is ``total``, the rest of the row breaks ties, so that the result repeats.
    """
    ordered = {c for c in order if isinstance(c, str)}
    rest = [] if total else [c for c in df.columns if c not in keys and c not in ordered]
    by = [*order, *rest] or [F.lit(0)]
    # A time, of which there are few, comes last: the first key's prefix then settles most comparisons of the sort.
    times = {c for c, kind in df.dtypes if kind.startswith("timestamp")}
    rank = F.row_number().over(Window.partitionBy(*sorted(keys, key=lambda k: k in times)).orderBy(*by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def nulls_last(*columns: str) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def merge_by_key(
    existing: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Upsert: a staged row replaces the existing row of its key, other existing rows stay."""
    tagged = staged.withColumn("_stored", F.lit(0)).unionByName(existing.withColumn("_stored", F.lit(1)))
    return distinct_on(tagged, keys, ["_stored", *order]).drop("_stored")


def newest_by_key(
    df: DataFrame, keys: Sequence[str], version: str, order: Sequence[Column | str] = ()
) -> DataFrame:
    """Row of the highest ``version`` of each key, then the first by ``order``; the order of arrival plays no part."""
    return distinct_on(df, keys, [F.desc(version), *order])


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work units without a finished marker."""
    return work.join(done, list(keys), "left_anti")
