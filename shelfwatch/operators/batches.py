"""Fixed-size request batches over a sorted key, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_SIZE = 300
# Keys per range of the rank computation: a range of distinct 32-bit keys holds at most this many rows, and
# 32 bits make at most 42,950 ranges, which bounds both the window groups and the broadcast offsets.
_RANGE = 100_000


def sku_batches(skus: DataFrame, column: str = "sku", size: int = BATCH_SIZE) -> DataFrame:
    """(batch, skus): distinct skus in ascending order, ``size`` per batch, the last one shorter.

    The rank of a sku is the number of skus in lower ranges plus its place in its own range.
    """
    distinct = skus.select(F.col(column).cast("int").alias("sku")).distinct()
    ranged = distinct.withColumn("_range", F.floor(F.col("sku") / _RANGE).cast("int"))
    offsets = (
        ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_range", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy("sku"))
    # Every range has its offset; an outer join adds no filter, so both sides share the exchange of ``distinct``.
    ranked = ranged.withColumn("_place", in_range).join(F.broadcast(offsets), "_range", "left")
    batch = F.call_function("div", F.col("_before") + F.col("_place") - 1, F.lit(size))
    return (
        ranked.withColumn("batch", batch)
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list("sku")).alias("skus"))
    )
