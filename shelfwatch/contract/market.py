"""Two days of a market derived from the driver's tables: all thirteen tables and the rejects after three runs.

A full run, a point run of the same day and the next day's full run, once as batch jobs in order, once as a stream
whose replies come in many files, an empty page after the pages behind it and the oldest snapshot's rest last. Both have
one oracle, which works the final tables out relationally, without JSON and without runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.contract.replies import as_landing, image_sql
from shelfwatch.contract.tables import cents, table
from shelfwatch.operators import extract as E
from shelfwatch.plans.jobs import run_full, run_point
from shelfwatch.session import scratch_folder
from shelfwatch.sources.landing import append_landing, read_landing, read_warehouse_file, stream_landing
from shelfwatch.sources.warehouse import Files, Warehouse, part_of, time_of
from shelfwatch.streaming.snapshots import stream_snapshots
from shelfwatch.tables import TABLES

FIRST, POINT, SECOND, CLOSING = (
    "2024-01-01 00:00:00", "2024-01-01 03:00:00", "2024-01-02 00:00:00", "2024-01-02 03:00:00",
)


def _sources(spark, folder, snapshot: str) -> DataFrame:
    """Menus, query lists and catalog replies; the second day lists fewer nations."""
    c = F.col
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
    if snapshot == SECOND:
        nations = nations.where("n_nationkey % 5 <> 0")
    own = F.concat_ws("/", "r_name", "n_name")
    node = F.struct(
        c("r_name").alias("name"), F.lit("/catalog").alias("url"), F.lit("r").alias("shard"),
        F.array(F.struct(c("n_name").alias("name"), F.lit("/catalog/n").alias("url"), F.lit("c").alias("shard"))).alias("childs"),
    )
    common = {"code": F.lit(200), "snapshot_ts": F.lit(snapshot), "ingest_seq": c("n_nationkey")}

    def catalog(text, shard, query):
        body = F.to_json(F.struct(F.lit(shard).alias("shardKey"), query.alias("query")))
        return as_landing(nations, endpoint=F.lit("catalog"), source_text=text, body=body, **common)

    hat, sock = F.concat(F.lit("hat "), c("n_regionkey")), F.concat(F.lit("sock "), c("n_nationkey") % 7)
    parts = [
        as_landing(nations, endpoint=F.lit("categories"), body=F.to_json(F.array(node)), **common),
        as_landing(
            nations, endpoint=F.lit("queries"), source_kind=F.lit("category"), source_text=own,
            body=F.to_json(F.array(hat, F.lit("12"), sock)), **common,
        ),
        catalog(own, "c", F.concat(F.lit("n="), c("n_nationkey"))),
        catalog(c("r_name"), "r", F.concat(F.lit("r="), c("n_regionkey"))).where("source_text LIKE 'A%'"),
        catalog(hat, "presets/h", F.concat(F.lit("r="), c("n_regionkey"))),
        catalog(sock, "presets/s", F.concat(F.lit("s="), c("n_nationkey") % 7)).where("source_text <> 'sock 3'"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _products(spark, folder, snapshot: str) -> DataFrame:
    """Pages 0 to 18, page 17 of some parts with 250 products, empty pages, and seller replies."""
    c = F.col
    parts = table(spark, folder, "part")
    if snapshot == SECOND:
        parts = parts.where("p_partkey % 3 <> 0")
    shift = 100 if snapshot == SECOND else 0

    def item(sku):
        return F.struct(
            sku.alias("id"), F.concat(c("p_name"), F.lit(f" {shift}")).alias("name"), c("p_brand").alias("brand"),
            (c("p_size") + 1).alias("brandId"), (cents(c("p_retailprice")) + shift).alias("priceU"),
            cents(c("p_retailprice")).alias("salePriceU"), (c("p_size") % 6).alias("rating"), c("p_size").alias("feedbacks"),
        )

    long = c("p_partkey") % 40 == 7
    listed = F.when(
        long, F.transform(F.sequence(F.lit(1), F.lit(250)), lambda i: item(c("p_partkey") * 300 + 5_000_000 + i))
    ).otherwise(F.array(item(c("p_partkey"))))
    pages = as_landing(
        parts, endpoint=F.lit("page"), shard=F.lit("c"), query=F.concat(F.lit("n="), c("p_partkey") % 25),
        page=F.when(long, 17).otherwise(c("p_size") % 19), code=F.lit(200),
        body=F.to_json(F.struct(F.struct(listed.alias("products")).alias("data"))), snapshot_ts=F.lit(snapshot),
        ingest_seq=c("p_partkey"),
    )
    empty = as_landing(
        table(spark, folder, "nation").where("n_nationkey % 6 = 4"), endpoint=F.lit("page"), shard=F.lit("c"),
        query=F.concat(F.lit("n="), c("n_nationkey")), page=F.lit(9), code=F.lit(404), snapshot_ts=F.lit(snapshot),
        ingest_seq=-c("n_nationkey") - 1,
    )
    seller = c("p_partkey") % 10 + (1 if snapshot == SECOND else 0)
    sellers = as_landing(
        parts, endpoint=F.lit("seller"), sku=c("p_partkey"), code=F.when(c("p_partkey") % 4 == 0, 404).otherwise(200),
        body=F.to_json(F.struct(seller.alias("supplierId"), c("p_type").alias("trademark"), F.concat(F.lit("i"), c("p_partkey")).alias("inn"))),
        snapshot_ts=F.lit(snapshot), ingest_seq=c("p_partkey"),
    )
    pages = pages.unionByName(sellers)
    return pages.unionByName(empty) if snapshot == FIRST else pages


def _stocks(spark, folder) -> DataFrame:
    """Every line item is a stock reply of one of the three snapshots."""
    c = F.col
    level = F.struct(c("l_suppkey").alias("wh"), c("l_quantity").alias("qty"))
    size = F.struct(
        c("l_returnflag").alias("name"), F.concat(F.lit("S"), c("l_linenumber") % 3).alias("origName"), F.array(level).alias("stocks")
    )
    product = F.struct(c("l_partkey").alias("id"), F.array(size).alias("sizes"))
    when = F.when(c("l_linestatus") == "O", FIRST).when(c("l_linenumber") <= 3, POINT).otherwise(SECOND)
    return as_landing(
        table(spark, folder, "lineitem"), endpoint=F.lit("stocks"), code=F.lit(200),
        body=F.to_json(F.struct(F.struct(F.array(product).alias("products")).alias("data"))), snapshot_ts=when,
        ingest_seq=c("l_orderkey") * 10 + c("l_linenumber"),
    )


def market_landing(spark, folder) -> DataFrame:
    # The sources are small and many: one writer does. The others are dealt out evenly, and must stay so.
    sources = reduce(DataFrame.unionByName, [_sources(spark, folder, snapshot) for snapshot in (FIRST, SECOND)]).coalesce(1)
    products = [_products(spark, folder, snapshot) for snapshot in (FIRST, SECOND)]
    return reduce(DataFrame.unionByName, [sources, *products, _stocks(spark, folder)])


def warehouse_list(spark, folder) -> str:
    """A file whose first line lists nations as warehouses, their names read as Latin-1, and whose second is no list."""
    c = F.col
    name = F.decode(F.encode(F.concat(F.lit("Склад "), c("n_name")), "UTF-8"), "ISO-8859-1")
    listed = table(spark, folder, "nation").select(F.struct((c("n_nationkey") + 1).alias("origid"), name.alias("warehouse")).alias("w"))
    data = listed.agg(F.sort_array(F.collect_list("w")).alias("data"))
    body = F.to_json(F.struct(F.struct(F.struct("data").alias("resp")).alias("result")))
    path = scratch_folder(spark, "warehouse-list")
    data.select(F.concat(body, F.lit('\n{"result": null}\n')).alias("value")).write.text(path)
    return path


def _text(*columns: str):
    return F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("~")) for n in columns])


def all_tables(warehouse: Warehouse) -> DataFrame:
    """Every row of every table, and the number of rejects by snapshot, place and reason, as text."""
    frames = []
    for name, spec in TABLES.items():
        stamp = "timestamp" if spec.is_history else "last_timestamp"
        key = [k for k in spec.key if k != "timestamp"]
        value = [n for n in spec.final.names if n not in (*key, stamp)]
        rows = warehouse.read(name).withColumn("ts", F.date_format(stamp, "ddHH"))
        if "timestamp_to" in value:
            rows = rows.withColumn("timestamp_to", F.date_format("timestamp_to", "ddHH"))
        frames.append(rows.select(F.lit(name).alias("table_name"), "ts", _text(*key).alias("k"), _text(*value).alias("v")))
    for part in (part_of(time) for time in map(_utc, (FIRST, POINT, SECOND))):
        day, point = part.split("/")
        folder = f"{warehouse.root}/_rejects/day={day}/point={point}"
        for name in warehouse.files.names(folder):
            rows = warehouse.spark.read.parquet(f"{folder}/{name}").withColumn("reject", F.lit(name))
            labels = _text("reject", *(["stage"] if name == "extraction" else []), "reason")
            frames.append(
                rows.groupBy(labels.alias("k")).agg(F.count("*").cast("string").alias("v"))
                .select(F.lit("rejects").alias("table_name"), F.lit(time_of(part).strftime("%d%H")).alias("ts"), "k", "v")
            )
    return reduce(DataFrame.unionByName, frames)


def _utc(text: str):
    return time_of(text[:10].replace("-", "") + "/" + text[11:].replace(":", ""))


def full_run_tables(spark, folder) -> DataFrame:
    """The three runs as batch jobs."""
    path, names = scratch_folder(spark, "landing"), warehouse_list(spark, folder)
    append_landing(market_landing(spark, folder), path)
    landing = read_landing(spark, path)
    warehouse = Warehouse(spark, scratch_folder(spark, "warehouse"))
    run_full(warehouse, landing, _utc(FIRST), names)
    run_point(warehouse, landing, _utc(POINT), names)
    run_full(warehouse, landing, _utc(SECOND), names)
    return all_tables(warehouse)


def _arrive(files: Files, source: str, path: str, prefix: str) -> None:
    """Move stored replies into the landing, as a crawler would that writes its files aside first."""
    for snapshot in files.names(source):
        for endpoint in files.names(f"{source}/{snapshot}"):
            for name in files.names(f"{source}/{snapshot}/{endpoint}"):
                files.move(f"{source}/{snapshot}/{endpoint}/{name}", f"{path}/{snapshot}/{endpoint}/{prefix}{name}")


def stream_runs(spark, folder) -> DataFrame:
    """The same replies as a stream in five drains; the first snapshot's empty pages, sellers and stocks come in part last."""
    path, checkpoint, names = scratch_folder(spark, "landing"), scratch_folder(spark, "checkpoint"), warehouse_list(spark, folder)
    warehouse = Warehouse(spark, scratch_folder(spark, "warehouse"))
    source = scratch_folder(spark, "replies")
    late = F.expr(
        f"snapshot_ts = timestamp '{FIRST}' AND (endpoint = 'page' AND code = 404 OR endpoint IN ('seller', 'stocks') AND ingest_seq % 7 = 1)"
    )
    at, even = F.col("snapshot_ts"), F.col("ingest_seq") % 2 == 0
    step = (
        F.when(late, 4).when((at == FIRST) & ~late & even, 0).when((at == FIRST) & ~late & (F.col("ingest_seq") % 2 == 1), 1)
        .when((at == POINT) & even, 2).when((at == POINT) & ~even, 3).when(at == SECOND, 3)
    )
    dealt = market_landing(spark, folder).withColumn("step", step).where("step IS NOT NULL")
    dealt.write.partitionBy("step", "snapshot_ts", "endpoint").parquet(source)
    closing = as_landing(spark.range(1), endpoint=F.lit("page"), code=F.lit(500), snapshot_ts=F.lit(CLOSING), ingest_seq=F.lit(0))
    for steps in ([0, 1], [2], [3], [], [4]):
        for k in steps:
            _arrive(warehouse.files, f"{source}/step={k}", path, f"step{k}-")
        if not steps:
            append_landing(closing, path)
        arrivals = stream_landing(spark, path, maxFilesPerTrigger=1000)
        stream_snapshots(warehouse, arrivals, read_landing(spark, path), checkpoint, warehouse_file=names).awaitTermination()
    return all_tables(warehouse)


_BRAND = "'https://images.wbstatic.net/brands/small/' || {0} || '.jpg'"
_SELLER = "'https://images.wbstatic.net/shops/' || {0} || '_logo.jpg'"

# Days are 0101 and so on: day and hour of a snapshot, as text in order.
MARKET_SQL = f"""
WITH runs AS (SELECT unnest(['0100', '0103', '0200']) AS ts),
nations AS (
  SELECT ts, n_nationkey AS k, n_regionkey AS rk, r_name, r_name || '/' || n_name AS own
  FROM nation JOIN region ON n_regionkey = r_regionkey, runs WHERE ts = '0100' OR ts = '0200' AND n_nationkey % 5 <> 0
),
texts AS (
  SELECT DISTINCT ts, 'categories' AS kind, unnest([r_name, own]) AS text FROM nations
  UNION ALL SELECT DISTINCT ts, 'queries', unnest(['hat ' || rk, 'sock ' || k % 7]) FROM nations
),
answers AS (
  SELECT DISTINCT ts, own AS text, 'c' AS shard, 'n=' || k AS query FROM nations
  UNION SELECT ts, r_name, 'r', 'r=' || rk FROM nations WHERE r_name LIKE 'A%'
  UNION SELECT ts, 'hat ' || rk, 'presets/h', 'r=' || rk FROM nations
  UNION SELECT ts, 'sock ' || k % 7, 'presets/s', 's=' || k % 7 FROM nations WHERE k % 7 <> 3
),
bound AS (SELECT ts, kind, text, shard, query FROM texts LEFT JOIN answers USING (ts, text)),
parts AS (
  SELECT ts, p.*, CASE ts WHEN '0200' THEN 100 ELSE 0 END AS shift, p_partkey % 25 AS nk, p_partkey % 40 = 7 AS long,
         CASE WHEN p_partkey % 40 = 7 THEN 17 ELSE p_size % 19 END AS page
  FROM part p, runs WHERE ts = '0100' OR ts = '0200' AND p_partkey % 3 <> 0
),
empties AS (SELECT '0100' AS ts, n_nationkey AS nk, 9 AS empty_page FROM nation WHERE n_nationkey % 6 = 4),
listed AS (
  SELECT parts.*, CAST(CASE WHEN long THEN p_partkey * 300 + 5000000 + i ELSE p_partkey END AS INTEGER) AS sku,
         (page - 1) * 300 + i AS place
  FROM parts LEFT JOIN empties e USING (ts, nk), range(1, 251) r(i)
  WHERE (long OR i = 1) AND page BETWEEN 1 AND 17 AND (page - 1) * 300 + i <= {E.POSITION_PLACE_CAP} AND (e.empty_page IS NULL OR page <= e.empty_page)
),
found AS (
  SELECT ts, CAST(p_partkey AS INTEGER) AS sku, CAST(p_partkey % 10 + shift // 100 AS INTEGER) AS wb_id, p_type AS name, 'i' || p_partkey AS inn
  FROM parts WHERE p_partkey % 4 <> 0
),
first_listed AS (
  SELECT *, CAST(p_size + 1 AS INTEGER) AS brand FROM listed
  QUALIFY row_number() OVER (PARTITION BY ts, sku ORDER BY page, place, nk::VARCHAR, p_partkey) = 1
),
brands AS (
  SELECT ts, CAST(p_size + 1 AS INTEGER) AS wb_id, p_brand AS name FROM listed
  QUALIFY row_number() OVER (PARTITION BY ts, p_size ORDER BY page, place, 'n=' || nk, p_partkey) = 1
),
sellers AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY ts, wb_id ORDER BY sku) = 1),
products AS (
  SELECT l.ts, l.sku, p_name || ' ' || shift AS name, brand, f.wb_id AS seller FROM first_listed l LEFT JOIN found f ON f.ts = l.ts AND f.sku = l.sku
),
asked AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN '0100' WHEN l_linenumber <= 3 THEN '0103' ELSE '0200' END AS ts,
         CAST(l_partkey AS INTEGER) AS sku, 'S' || l_linenumber % 3 AS size_name, l_returnflag AS alt_name,
         CAST(l_suppkey AS INTEGER) AS wh, CAST(l_quantity AS INTEGER) AS qty, l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem
),
-- A point run reads replies of the day's products alone; a full run rejects rows of products it doesn't know.
levels AS (
  SELECT a.*, EXISTS (SELECT 1 FROM products p WHERE p.sku = a.sku AND p.ts <= a.ts) AS known
  FROM asked a WHERE ts <> '0103' OR EXISTS (SELECT 1 FROM products p WHERE p.sku = a.sku AND p.ts = '0100')
),
sizes AS (
  SELECT * FROM levels QUALIFY row_number() OVER (PARTITION BY ts, sku, size_name ORDER BY seq) = 1
),
stocks AS (
  SELECT * FROM levels QUALIFY row_number() OVER (PARTITION BY ts, sku, size_name, wh ORDER BY seq) = 1
),
depots AS (
  SELECT ts, wh, max(name) AS name FROM (
    SELECT ts, wh, CAST(NULL AS VARCHAR) AS name FROM levels
    UNION ALL SELECT ts, CAST(n_nationkey + 1 AS INTEGER), 'Склад ' || n_name FROM nation, runs
  ) GROUP BY ts, wh
),
changes AS (
  SELECT a.ts, b.ts AS ts_to, a.sku, a.size_name, a.wh, b.qty - a.qty AS diff
  FROM stocks a JOIN stocks b USING (sku, size_name, wh)
  WHERE a.known AND b.known AND (a.ts, b.ts) IN (('0100', '0103'), ('0103', '0200')) AND a.qty <> b.qty
),
every AS (
  SELECT DISTINCT 'catalogs' AS table_name, ts, shard || '|' || query AS k, '' AS v FROM bound WHERE shard IS NOT NULL
  UNION ALL SELECT kind, ts, text, shard || '|' || query FROM bound WHERE shard IS NOT NULL
  UNION ALL SELECT 'brands', ts, wb_id::VARCHAR, name || '|' || {_BRAND.format('wb_id')} FROM brands
  UNION ALL SELECT 'sellers', ts, wb_id::VARCHAR, name || '|' || {_SELLER.format('wb_id')} || '|' || inn || '|~|~|~' FROM sellers
  UNION ALL SELECT 'products', ts, sku::VARCHAR, name || '|' || {image_sql('sku')} || '|' || brand || '|' || coalesce(seller::VARCHAR, '~') FROM products
  UNION ALL SELECT 'sizes', ts, sku || '|' || size_name, alt_name FROM sizes WHERE known
  UNION ALL SELECT 'warehouses', ts, wh::VARCHAR, coalesce(name, '~') FROM depots
),
dictionaries AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY table_name, k ORDER BY ts DESC) = 1),
histories AS (
  SELECT 'product_details' AS table_name, ts, sku::VARCHAR AS k,
         (CAST(floor(p_retailprice * 100) AS BIGINT) + shift) // 100 || '|' || CAST(floor(p_retailprice * 100) AS BIGINT) // 100
           || '|' || p_size || '|' || p_size % 6 AS v FROM first_listed
  UNION ALL SELECT 'positions', ts, sku || '|c|n=' || nk, min(place)::VARCHAR FROM listed GROUP BY ts, sku, nk
  UNION ALL SELECT 'stocks', ts, sku || '|' || size_name || '|' || wh, qty::VARCHAR FROM stocks WHERE known
  UNION ALL SELECT CASE WHEN diff < 0 THEN 'orders' ELSE 'refills' END, ts, sku || '|' || size_name || '|' || wh, ts_to || '|' || abs(diff) FROM changes
),
refused AS (
  SELECT ts, 'extraction|page|page out of range' AS k FROM parts WHERE page NOT BETWEEN 1 AND 17
  UNION ALL SELECT ts, 'extraction|sources|no catalog reply' FROM bound WHERE shard IS NULL
  UNION ALL SELECT ts, 'sizes|unknown in products' FROM sizes WHERE NOT known
  UNION ALL SELECT ts, 'stocks|unknown in sizes' FROM stocks WHERE NOT known
)
SELECT * FROM dictionaries UNION ALL SELECT * FROM histories
UNION ALL SELECT 'rejects', ts, k, count(*)::VARCHAR FROM refused GROUP BY ts, k
"""


def warehouse_names(spark, folder) -> DataFrame:
    """Warehouses that the file's first line names."""
    return E.extract_warehouses(read_warehouse_file(spark, warehouse_list(spark, folder)))


WAREHOUSE_NAMES_SQL = "SELECT CAST(n_nationkey + 1 AS INTEGER) AS wb_id, 'Склад ' || n_name AS name FROM nation"

QUERIES = {
    "full_run_tables": (full_run_tables, MARKET_SQL),
    "stream_runs": (stream_runs, MARKET_SQL),
    "warehouse_file": (warehouse_names, WAREHOUSE_NAMES_SQL),
}
