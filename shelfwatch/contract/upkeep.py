"""Upkeep of a month of snapshots, and staging files taken into tables, by the shipped jobs."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.contract.replies import image_sql
from shelfwatch.contract.snapshots import _CHANGES, snapshots_of
from shelfwatch.contract.tables import naive, table
from shelfwatch.functions.calendar import midnight
from shelfwatch.functions.urls import product_image_url
from shelfwatch.plans.jobs import compact, import_files, retain
from shelfwatch.session import scratch_folder
from shelfwatch.sources.staging_text import write_staging_text
from shelfwatch.sources.warehouse import Warehouse, time_of
from shelfwatch.streaming.snapshots import apply_stock_batch
from shelfwatch.tables import TABLES


def upkeep_runs(spark, folder) -> DataFrame:
    """Stocks, changes and products after the upkeep of some days of a month, each done twice."""
    warehouse = Warehouse(spark, scratch_folder(spark, "upkeep"))
    snaps = snapshots_of(table(spark, folder, "events")).select(
        F.col("timestamp").cast("timestamp").alias("timestamp"), F.col("user_id").cast("int").alias("product_sku"),
        F.col("event_type").alias("size_name"), F.lit(1).alias("warehouse_wb_id"), "quantity",
    )
    apply_stock_batch(warehouse, snaps)
    seen = snaps.groupBy(F.col("product_sku").alias("sku")).agg(F.max("timestamp").alias("timestamp"))
    warehouse.upsert_dictionary(
        "products",
        seen.select("timestamp", "sku", F.lit("p").alias("name"), F.lit("").alias("image_url"), F.lit(1).alias("brand_wb_id"), F.lit(None).cast("int").alias("seller_wb_id")),
    )
    days = sorted({midnight(t) for t in warehouse.snapshot_times("stocks")})
    for day in [d for k, d in enumerate(days, 1) if k in (3, 10, 11)] + [days[-1] + timedelta(days=1)]:
        for _ in range(2):
            compact(warehouse, day)
    for _ in range(2):
        retain(warehouse, days[-1] + timedelta(days=5))
    parts = [
        warehouse.read(name).select(F.lit(name).alias("table_name"), "timestamp", until, "product_sku", "size_name", "quantity")
        for name, until in (("stocks", F.lit(None).cast("timestamp").alias("timestamp_to")), ("orders", "timestamp_to"), ("refills", "timestamp_to"))
    ]
    products = warehouse.read("products").select(
        F.lit("products").alias("table_name"), F.col("last_timestamp").alias("timestamp"), F.lit(None).cast("timestamp").alias("timestamp_to"),
        F.col("sku").alias("product_sku"), F.lit(None).cast("string").alias("size_name"), F.lit(None).cast("int").alias("quantity"),
    )
    return naive(reduce(DataFrame.unionByName, [*parts, products]))


UPKEEP_SQL = f"""
WITH {_CHANGES},
days AS (SELECT day, row_number() OVER (ORDER BY day) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT date_trunc('day', timestamp) AS day FROM snap)),
packed AS (SELECT day FROM days WHERE k IN (CASE WHEN n >= 3 THEN 1 END, CASE WHEN n >= 10 THEN 8 END, CASE WHEN n >= 11 THEN 9 END, n - 1)),
edge AS (SELECT max(day) - INTERVAL 25 DAY AS edge FROM days),
firsts AS (SELECT date_trunc('day', timestamp) AS day, min(timestamp) AS first FROM snap GROUP BY 1),
facts AS (
  SELECT CASE WHEN diff < 0 THEN 'orders' ELSE 'refills' END AS table_name, timestamp, timestamp_to, user_id, event_type, abs(diff) AS quantity,
         date_trunc('day', timestamp) IN (SELECT day FROM packed) AS is_packed FROM changes
),
summed AS (
  SELECT table_name, min(timestamp) AS timestamp, max(timestamp_to) AS timestamp_to, user_id, event_type, CAST(sum(quantity) AS INTEGER) AS quantity
  FROM facts WHERE is_packed GROUP BY table_name, date_trunc('day', timestamp), user_id, event_type
),
every AS (
  SELECT table_name, timestamp, timestamp_to, user_id, event_type, quantity FROM facts WHERE NOT is_packed
  UNION ALL SELECT * FROM summed
  UNION ALL SELECT 'stocks', timestamp, NULL, user_id, event_type, quantity FROM snap JOIN firsts ON firsts.day = date_trunc('day', timestamp)
  WHERE timestamp = first OR date_trunc('day', timestamp) NOT IN (SELECT day FROM packed)
  UNION ALL SELECT 'products', max(timestamp), NULL, user_id, NULL, NULL FROM snap GROUP BY user_id
)
SELECT table_name, timestamp, timestamp_to, CAST(user_id AS INTEGER) AS product_sku, event_type AS size_name, quantity
FROM every, edge WHERE timestamp >= edge
"""

_STAGED = time_of("20240301/000000")


def staging_files(spark, folder) -> DataFrame:
    """Products and sizes by way of staging files, written twice and imported twice, with lines that are no rows."""
    path = scratch_folder(spark, "staging")
    c = F.col
    parts = table(spark, folder, "part")
    when = F.lit(_STAGED).alias("timestamp")
    brands = parts.groupBy((c("p_size") + 1).alias("wb_id")).agg(F.min("p_brand").alias("name")).select(when, "wb_id", "name", F.lit("x\ty").alias("image_url"))
    products = parts.select(
        when, c("p_partkey").cast("int").alias("sku"), F.concat(F.lit("\\"), "p_name").alias("name"), product_image_url(c("p_partkey").cast("int")).alias("image_url"),
        F.when(c("p_size") < 45, c("p_size") + 1).otherwise(900).alias("brand_wb_id"), F.lit(None).cast("int").alias("seller_wb_id"),
    )
    sizes = table(spark, folder, "lineitem").select(
        when, c("l_partkey").cast("int").alias("product_sku"), F.concat(F.lit("S"), "l_linenumber").alias("name"),
        F.when(c("l_linenumber") > 1, c("l_linenumber").cast("string")).otherwise("\\N").alias("alt_name"),
    ).distinct()
    for name, rows in (("brands", brands), ("products", products), ("sizes", sizes)):
        write_staging_text(rows.select(*TABLES[name].staging.names), TABLES[name], f"{path}/{name}")
        # The second time the same lines, without making the rows again.
        spark.read.option("lineSep", "\n").text(f"{path}/{name}").write.mode("append").text(f"{path}/{name}")
    # A number that is none for some parts, a field too few for others, and another snapshot's time.
    bad = F.when(c("p_partkey") % 3 == 0, F.concat_ws("\t", F.lit("2024-03-01 00:00:00.0"), F.lit("x"), F.lit("S1"), F.lit("a"))).when(
        c("p_partkey") % 3 == 1, F.lit("2024-03-01 00:00:00.0\t1\tS1")
    ).otherwise(F.concat_ws("\t", F.lit("2024-02-01 00:00:00.0"), c("p_partkey").cast("string"), F.lit("S9"), F.lit("a")))
    parts.select(bad.alias("value")).write.mode("append").text(f"{path}/sizes")
    warehouse = Warehouse(spark, scratch_folder(spark, "warehouse"))
    for _ in range(2):
        import_files(warehouse, path, _STAGED)
    read = warehouse.read
    rejected = reduce(
        DataFrame.unionByName,
        [
            spark.read.parquet(f"{warehouse.root}/_rejects/day=20240301/point=000000/{name}").select(F.lit(name).alias("name"), "reason")
            for name in ("sizes-lines", "products", "sizes")
        ],
    ).groupBy("name", "reason").agg(F.count("*").cast("string").alias("n"))
    return (
        read("products").select(F.lit("products").alias("table_name"), c("sku").cast("string").alias("k"), F.concat_ws("|", "name", "image_url").alias("v"))
        .unionByName(read("brands").select(F.lit("brands").alias("table_name"), c("wb_id").cast("string").alias("k"), F.concat_ws("|", "name", "image_url").alias("v")))
        .unionByName(read("sizes").select(F.lit("sizes").alias("table_name"), F.concat_ws("|", "product_sku", "name").alias("k"), c("alt_name").alias("v")))
        .unionByName(rejected.select(F.lit("rejects").alias("table_name"), F.concat_ws("|", "name", "reason").alias("k"), c("n").alias("v")))
    )


STAGING_FILES_SQL = rf"""
WITH kept AS (SELECT * FROM part WHERE p_size < 45),
listed AS (SELECT DISTINCT l_partkey, l_linenumber FROM lineitem)
SELECT 'products' AS table_name, p_partkey::VARCHAR AS k, '\' || p_name || '|' || {image_sql('p_partkey')} AS v FROM kept
UNION ALL SELECT 'brands', (p_size + 1)::VARCHAR, min(p_brand) || '|xy' FROM part GROUP BY p_size
UNION ALL SELECT 'sizes', l_partkey || '|S' || l_linenumber, CASE WHEN l_linenumber > 1 THEN l_linenumber::VARCHAR ELSE '\N' END
  FROM listed WHERE l_partkey IN (SELECT p_partkey FROM kept)
UNION ALL SELECT 'rejects', 'sizes-lines|' || CASE p_partkey % 3 WHEN 0 THEN 'bad product_sku' WHEN 1 THEN '3 fields' ELSE 'other snapshot' END, count(*)::VARCHAR
  FROM part GROUP BY p_partkey % 3
UNION ALL SELECT 'rejects', 'products|unknown in brands', (2 * count(*))::VARCHAR FROM part WHERE p_size >= 45 HAVING count(*) > 0
UNION ALL SELECT 'rejects', 'sizes|unknown in products', (2 * count(*))::VARCHAR FROM listed WHERE l_partkey NOT IN (SELECT p_partkey FROM kept) HAVING count(*) > 0
"""

QUERIES = {"upkeep_runs": (upkeep_runs, UPKEEP_SQL), "staging_files": (staging_files, STAGING_FILES_SQL)}
