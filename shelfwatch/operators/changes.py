"""Orders and refills from consecutive stock snapshots.

A fall in quantity between two snapshots is an order, a rise is a refill. A key that is missing from either
snapshot gives nothing: the partner of a snapshot is the next one of the whole table, not of the key.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MERCH_KEY = ["product_sku", "size_name", "warehouse_wb_id"]


def previous_snapshot(stocks: DataFrame, bound: Column | datetime) -> DataFrame:
    """Newest snapshot time before ``bound``, one row, null if there is none."""
    return stocks.where(F.col("timestamp") < bound).agg(F.max("timestamp").alias("timestamp"))


def first_snapshot(stocks: DataFrame, bound: Column | datetime) -> DataFrame:
    """Oldest snapshot time at or after ``bound``, one row, null if there is none."""
    return stocks.where(F.col("timestamp") >= bound).agg(F.min("timestamp").alias("timestamp"))


def at_snapshot(stocks: DataFrame, ts: Column | datetime) -> DataFrame:
    return stocks.where(F.col("timestamp") == ts)


def snapshot_changes(older: DataFrame, newer: DataFrame, keys: list[str] = MERCH_KEY) -> DataFrame:
    """Quantity differences of one pair of snapshots.

    Unknown differences are dropped along with zero ones, so the outer join on the older side shrinks to an
    inner join. Keys are unique within a snapshot, which keeps the shuffle even.
    """
    after = newer.select(*keys, F.col("timestamp").alias("timestamp_to"), F.col("quantity").alias("_after"))
    return (
        older.select(*keys, "timestamp", "quantity")
        .join(after, keys, "inner")
        .withColumn("diff", F.col("_after") - F.col("quantity"))
        .where("diff <> 0")
        .select("timestamp", "timestamp_to", *keys, "diff")
    )


def next_snapshots(times: DataFrame) -> DataFrame:
    """Pairs (timestamp, timestamp_to) of neighbouring snapshot times.

    ``times`` has one column ``timestamp``. Distinct times lie on the snapshot grid, eight a day, so the one
    sorted task of this window holds a few thousand rows a year whatever the size of the tables.
    """
    distinct = times.select("timestamp").distinct()
    step = F.lead("timestamp").over(Window.orderBy("timestamp"))
    return distinct.withColumn("timestamp_to", step).where(F.col("timestamp_to").isNotNull())


def history_changes(stocks: DataFrame, pairs: DataFrame, keys: list[str] = MERCH_KEY) -> DataFrame:
    """Differences of all neighbouring snapshots in one pass.

    One shuffle by key: the key's following row counts only if it is the table's next snapshot. ``pairs``
    must be small by construction (grid times, see ``next_snapshots``) and is broadcast. ``stocks`` must hold no
    snapshot between the two times of a pair, and one row per key and time.
    """
    by_key = Window.partitionBy(*keys).orderBy("timestamp")
    stepped = stocks.select(
        *keys, "timestamp", "quantity",
        F.lead("timestamp").over(by_key).alias("timestamp_to"),
        F.lead("quantity").over(by_key).alias("_after"),
    ).where("_after <> quantity")
    return (
        stepped.join(F.broadcast(pairs), ["timestamp", "timestamp_to"], "left_semi")
        .select("timestamp", "timestamp_to", *keys, (F.col("_after") - F.col("quantity")).alias("diff"))
    )


def split_changes(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders, refills) with positive quantities."""
    rest = [c for c in changes.columns if c != "diff"]
    return (
        changes.where("diff < 0").select(*rest, F.abs("diff").alias("quantity")),
        changes.where("diff > 0").select(*rest, F.col("diff").alias("quantity")),
    )


def neighbour_pairs(times: Iterable[datetime], touched: Iterable[datetime]) -> list[tuple[datetime, datetime]]:
    """Neighbouring pairs of snapshot times in which a touched snapshot takes part."""
    ordered = sorted(set(times))
    touched = set(touched)
    return [(a, b) for a, b in zip(ordered, ordered[1:]) if a in touched or b in touched]
