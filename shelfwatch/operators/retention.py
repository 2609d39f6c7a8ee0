"""Retention by whole days."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.calendar import midnight

# Fixed value: days of history kept.
DAY_HISTORY_LENGTH = 30


def retention_edge(day: datetime, keep_days: int = DAY_HISTORY_LENGTH) -> datetime:
    return midnight(day, -keep_days)


def keep_seen_since(dictionary: DataFrame, edge: Column | datetime) -> DataFrame:
    return dictionary.where(F.col("last_timestamp") >= edge)


def keep_days_since(history: DataFrame, edge: Column | datetime) -> DataFrame:
    """Rows of the day partitions that start at the edge or later."""
    return history.where(F.col("timestamp") >= edge)


def active_products(products: DataFrame, day: Column | datetime) -> DataFrame:
    return products.where(F.col("last_timestamp") >= day)
