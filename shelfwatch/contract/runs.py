"""A full run and a point run over a landing derived from the driver's tables.

Parts of up to size 40 are listed in catalog pages; every line item is a stock reply, open ones of the first
snapshot and finished ones of the second. Stock rows of unlisted parts have no product and are rejected.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.contract.replies import as_landing, source_landing
from shelfwatch.contract.tables import table
from shelfwatch.plans.jobs import run_full, run_point
from shelfwatch.session import scratch_folder
from shelfwatch.sources.landing import append_landing, read_landing
from shelfwatch.sources.warehouse import Warehouse

_FIRST, _SECOND = datetime(2024, 1, 1), datetime(2024, 1, 1, 3)


def _pages(spark, folder) -> DataFrame:
    c = F.col
    listed = F.struct(
        c("p_partkey").alias("id"), c("p_name").alias("name"), c("p_brand").alias("brand"),
        c("p_size").alias("brandId"), (c("p_size") * 100).alias("priceU"), (c("p_size") * 90).alias("salePriceU"),
        F.lit(5).alias("rating"), c("p_size").alias("feedbacks"),
    )
    return as_landing(
        table(spark, folder, "part").where("p_size <= 40"),
        endpoint=F.lit("page"), shard=F.lit("c"), query=F.concat(F.lit("n="), c("p_partkey") % 25), page=F.lit(1),
        code=F.lit(200), body=F.to_json(F.struct(F.struct(F.array(listed).alias("products")).alias("data"))),
        snapshot_ts=F.lit(str(_FIRST)), ingest_seq=c("p_partkey"),
    )


def _stocks(spark, folder) -> DataFrame:
    c = F.col
    level = F.struct(c("l_suppkey").alias("wh"), c("l_quantity").alias("qty"))
    size = F.struct(
        F.lit("any").alias("name"), F.concat(F.lit("S"), c("l_linenumber")).alias("origName"),
        F.array(level).alias("stocks"),
    )
    item = F.struct(c("l_partkey").alias("id"), F.array(size).alias("sizes"))
    return as_landing(
        table(spark, folder, "lineitem"),
        endpoint=F.lit("stocks"), code=F.lit(200),
        body=F.to_json(F.struct(F.struct(F.array(item).alias("products")).alias("data"))),
        snapshot_ts=F.when(c("l_linestatus") == "O", str(_FIRST)).otherwise(str(_SECOND)),
        ingest_seq=c("l_orderkey"),
    )


def snapshot_runs(spark, folder) -> DataFrame:
    """Stocks, orders and refills after both runs."""
    path = scratch_folder(spark, "landing")
    append_landing(
        reduce(
            DataFrame.unionByName,
            [source_landing(spark, folder), _pages(spark, folder), _stocks(spark, folder)],
        ),
        path,
    )
    landing = read_landing(spark, path)
    warehouse = Warehouse(spark, scratch_folder(spark, "warehouse"))
    run_full(warehouse, landing, _FIRST)
    run_point(warehouse, landing, _SECOND)
    return reduce(
        DataFrame.unionByName,
        [
            warehouse.read(name).select(
                F.lit(name).alias("table_name"), F.date_format("timestamp", "HH").alias("hour"), "product_sku",
                "size_name", "warehouse_wb_id", "quantity",
            )
            for name in ("stocks", "orders", "refills")
        ],
    )


SNAPSHOT_RUNS_SQL = """
WITH known AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN '00' ELSE '03' END AS hour, CAST(l_partkey AS INTEGER) AS product_sku,
         'S' || l_linenumber AS size_name, CAST(l_suppkey AS INTEGER) AS warehouse_wb_id,
         CAST(l_quantity AS INTEGER) AS quantity, l_orderkey
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <= 40
),
stocks AS (
  SELECT hour, product_sku, size_name, warehouse_wb_id, quantity FROM known
  QUALIFY row_number() OVER (
    PARTITION BY hour, product_sku, size_name, warehouse_wb_id ORDER BY l_orderkey, quantity) = 1
),
changes AS (
  SELECT a.hour, a.product_sku, a.size_name, a.warehouse_wb_id, b.quantity - a.quantity AS diff
  FROM stocks a JOIN stocks b USING (product_sku, size_name, warehouse_wb_id)
  WHERE a.hour = '00' AND b.hour = '03' AND a.quantity <> b.quantity
)
SELECT 'stocks' AS table_name, hour, product_sku, size_name, warehouse_wb_id, quantity FROM stocks
UNION ALL
SELECT CASE WHEN diff < 0 THEN 'orders' ELSE 'refills' END, hour, product_sku, size_name, warehouse_wb_id, abs(diff)
FROM changes
"""

QUERIES = {"snapshot_runs": (snapshot_runs, SNAPSHOT_RUNS_SQL)}
