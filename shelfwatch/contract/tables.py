"""Access to the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Times without a zone, as the oracle has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


def cents(amount: Column) -> Column:
    return F.floor(amount * 100).cast("bigint")
