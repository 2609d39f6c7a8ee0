"""Compaction of an older day: first stock snapshot only, orders and refills summed per key."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.calendar import midnight
from shelfwatch.operators.changes import MERCH_KEY


def compact_changes(facts: DataFrame, keys: list[str] = MERCH_KEY) -> DataFrame:
    """Sum orders or refills of one day per key; a sum that leaves 32 bits fails."""
    return (
        facts.groupBy(*keys)
        .agg(
            F.min("timestamp").alias("timestamp"),
            F.max("timestamp_to").alias("timestamp_to"),
            F.sum("quantity").cast("int").alias("quantity"),
        )
        .select("timestamp", "timestamp_to", *keys, "quantity")
    )


@dataclass(frozen=True)
class CompactionDay:
    start: datetime
    end: datetime
    first_snapshot: datetime


def compaction_day(times: Iterable[datetime], day: datetime) -> CompactionDay | None:
    """Data day before the last data day before ``day``; days without snapshots are skipped over.

    The last data day stays whole, so the next snapshot still finds its neighbour.
    """
    times = list(times)
    last = max((t for t in times if t < day), default=None)
    if last is None:
        return None
    second_last = max((t for t in times if t < midnight(last)), default=None)
    if second_last is None:
        return None
    start = midnight(second_last)
    return CompactionDay(start, midnight(second_last, 1), min(t for t in times if t >= start))
