"""Landing replies derived from the driver's tables, run through the extraction operators.

Every source row becomes one reply body, so no body grows with the data. The oracle computes the same rows
relationally, without JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.contract.tables import cents, naive, table
from shelfwatch.functions.urls import catalog_url, page_url, queries_url, seller_url
from shelfwatch.operators import extract as E
from shelfwatch.session import spread
from shelfwatch.sources.landing import LANDING, refused_replies, replies

_PLACE_CAP = E.POSITION_PLACE_CAP


def as_landing(df: DataFrame, **columns) -> DataFrame:
    """Landing columns; the ones not given are null."""
    return spread(df).select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LANDING.fields]
    )


# --- catalog pages ----------------------------------------------------------------------------------------


def page_landing(spark: SparkSession, folder: str) -> DataFrame:
    """One page per line item: the part, and for finished lines the supplier as a second product."""
    c = F.col
    fields = {
        "name": F.concat(F.lit("item "), c("l_returnflag")),
        "brand": F.concat(F.lit("brand "), c("l_returnflag"), c("l_linestatus")),
        "brandId": c("l_suppkey"),
        "priceU": cents(c("l_extendedprice")),
        "salePriceU": F.floor(c("l_extendedprice") * (1 - c("l_discount")) * 100).cast("bigint"),
        "rating": c("l_linenumber"),
        # Missing, and so rejected, on untaxed lines.
        "feedbacks": F.when(c("l_tax") != 0, c("l_quantity").cast("int")),
    }
    # Inexact, and so rejected, on lines with the highest tax.
    part = c("l_partkey").cast("decimal(20,1)") + F.when(c("l_tax") == 0.08, F.lit(0.5)).otherwise(0).cast("decimal(2,1)")
    products = F.array_compact(
        F.array(
            F.struct(part.alias("id"), *[v.alias(n) for n, v in fields.items()]),
            F.when(
                c("l_linestatus") == "F",
                F.struct((c("l_suppkey") + 200000).cast("decimal(22,1)").alias("id"), *[v.alias(n) for n, v in fields.items()]),
            ),
        )
    )
    body = F.to_json(F.struct(F.struct(products.alias("products")).alias("data")))
    return as_landing(
        table(spark, folder, "lineitem"),
        endpoint=F.lit("page"),
        shard=c("l_returnflag"),
        query=F.concat(F.lit("order="), c("l_orderkey")),
        page=c("l_linenumber"),
        code=F.when(c("l_discount") == 0.1, 404).otherwise(200),
        body=body,
        snapshot_ts=F.date_trunc("year", c("l_shipdate")),
        ingest_seq=c("l_orderkey") * 10 + c("l_linenumber"),
    )


_PAGES = f"""
replies AS (
  SELECT date_trunc('year', l_shipdate) AS snapshot_ts, l_returnflag AS shard, 'order=' || l_orderkey AS query,
         l_linenumber AS page, l_orderkey * 10 + l_linenumber AS ingest_seq, l_discount = 0.1 AS is_empty,
         l_partkey, l_suppkey, l_linestatus, l_tax,
         'item ' || l_returnflag AS name, 'brand ' || l_returnflag || l_linestatus AS brand,
         CAST(floor(l_extendedprice * 100) AS BIGINT) AS price_minor,
         CAST(floor(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) AS sale_price_minor,
         CAST(l_linenumber AS SMALLINT) AS rating, CAST(l_quantity AS INTEGER) AS feedbacks
  FROM lineitem
),
first_empty AS (
  SELECT snapshot_ts, shard, query, min(page) AS empty_page FROM replies WHERE is_empty GROUP BY ALL
),
kept AS (
  SELECT r.* FROM replies r LEFT JOIN first_empty e USING (snapshot_ts, shard, query)
  WHERE e.empty_page IS NULL OR r.page <= e.empty_page
),
listed AS (
  SELECT *, 1 AS ordinal, l_partkey AS listed_sku, l_tax = 0.08 AS inexact FROM kept WHERE NOT is_empty
  UNION ALL
  SELECT *, 2, l_suppkey + 200000, false FROM kept WHERE NOT is_empty AND l_linestatus = 'F'
),
placed AS (
  SELECT *, (page - 1) * 300 + ordinal AS place FROM listed WHERE (page - 1) * 300 + ordinal <= {_PLACE_CAP}
),
good AS (
  SELECT *, CAST(listed_sku AS INTEGER) AS sku, CAST(l_suppkey AS INTEGER) AS brand_wb_id
  FROM placed WHERE NOT inexact AND l_tax <> 0
)"""
_FIRST = "page, place, shard, query, ingest_seq"
_BUCKETS = """CASE WHEN {0} < 14400000 THEN '01' WHEN {0} < 28800000 THEN '02' WHEN {0} < 43200000 THEN '03'
  WHEN {0} < 72000000 THEN '04' WHEN {0} < 100800000 THEN '05' WHEN {0} < 106200000 THEN '06'
  WHEN {0} < 111600000 THEN '07' WHEN {0} < 117000000 THEN '08' WHEN {0} < 131400000 THEN '09'
  WHEN {0} < 160200000 THEN '10' ELSE '11' END"""


def bucket_sql(sku: str) -> str:
    return _BUCKETS.format(sku)


def image_sql(sku: str) -> str:
    return (
        f"'https://basket-' || {bucket_sql(sku)} || '.wb.ru/vol' || {sku} // 100000 || '/part' || {sku} // 1000 "
        f"|| '/' || {sku} || '/images/big/1.jpg'"
    )


def _page_part(name: str):
    def query(spark, folder):
        return naive(E.extract_pages(page_landing(spark, folder))[name])

    return query


PAGE_QUERIES = {
    "page_brands": (
        _page_part("brands"),
        f"""WITH {_PAGES}
        SELECT snapshot_ts, brand_wb_id AS wb_id, brand AS name,
               'https://images.wbstatic.net/brands/small/' || brand_wb_id || '.jpg' AS image_url
        FROM good
        QUALIFY row_number() OVER (PARTITION BY snapshot_ts, brand_wb_id ORDER BY {_FIRST}, brand) = 1""",
    ),
    "page_products": (
        _page_part("products"),
        f"""WITH {_PAGES}
        SELECT snapshot_ts, sku, name, {image_sql('sku')} AS image_url, brand_wb_id
        FROM good
        QUALIFY row_number() OVER (PARTITION BY snapshot_ts, sku ORDER BY {_FIRST}, name, brand_wb_id) = 1""",
    ),
    "page_details": (
        _page_part("product_details"),
        f"""WITH {_PAGES},
        details AS (
          SELECT snapshot_ts, sku AS product_sku, CAST(price_minor // 100 AS INTEGER) AS price,
                 CAST(sale_price_minor // 100 AS INTEGER) AS sale_price, feedbacks, rating, {_FIRST}
          FROM good
        )
        SELECT snapshot_ts, product_sku, price, sale_price, feedbacks, rating FROM details
        QUALIFY row_number() OVER (
          PARTITION BY snapshot_ts, product_sku ORDER BY {_FIRST}, price, sale_price, feedbacks, rating) = 1""",
    ),
    "page_positions": (
        _page_part("positions"),
        f"""WITH {_PAGES}
        SELECT snapshot_ts, sku AS product_sku, shard AS catalog_shard, query AS catalog_query,
               CAST(min(place) AS SMALLINT) AS place
        FROM good GROUP BY snapshot_ts, sku, shard, query""",
    ),
    "page_rejects": (
        _page_part("rejects"),
        f"""WITH {_PAGES}
        SELECT snapshot_ts, 'page' AS stage,
               'missing or inexact: ' || CASE WHEN inexact THEN 'sku' ELSE 'feedbacks' END AS reason,
               shard || ' ' || query || ' ' || page || ' place ' || place AS request, ingest_seq
        FROM placed WHERE inexact OR l_tax = 0""",
    ),
    "first_empty_page": (
        lambda spark, folder: naive(
            E.until_first_empty(E.written_pages(page_landing(spark, folder)), E.PRODUCTS_PER_PAGE, _PLACE_CAP)
            .select("snapshot_ts", "shard", "query", "page", "ingest_seq")
        ),
        f"WITH {_PAGES} SELECT snapshot_ts, shard, query, page, ingest_seq FROM kept",
    ),
}


# --- stocks -----------------------------------------------------------------------------------------------


def stock_landing(spark: SparkSession, folder: str) -> DataFrame:
    """One stock reply per line item; lines without discount list a size without stock rows."""
    c = F.col
    level = F.struct(c("l_suppkey").alias("wh"), c("l_quantity").alias("qty"))
    second = F.struct((c("l_suppkey") + 1000000).alias("wh"), c("l_linenumber").cast("double").alias("qty"))
    levels = F.when(c("l_discount") != 0, F.array_compact(F.array(level, F.when(c("l_linestatus") == "F", second))))
    size = F.struct(
        c("l_returnflag").alias("name"),
        F.concat(F.lit("S"), c("l_linenumber")).alias("origName"),
        F.coalesce(levels, F.array().cast("array<struct<wh: bigint, qty: double>>")).alias("stocks"),
    )
    item = F.struct(c("l_partkey").alias("id"), F.array(size).alias("sizes"))
    return as_landing(
        table(spark, folder, "lineitem"),
        endpoint=F.lit("stocks"), code=F.lit(200),
        body=F.to_json(F.struct(F.struct(F.array(item).alias("products")).alias("data"))),
        snapshot_ts=F.date_trunc("year", c("l_shipdate")),
        ingest_seq=c("l_orderkey") * 10 + c("l_linenumber"),
    )


_STOCKS = """
listed AS (
  SELECT date_trunc('year', l_shipdate) AS snapshot_ts, CAST(l_partkey AS INTEGER) AS product_sku,
         'S' || l_linenumber AS size_name, l_returnflag AS alt_name, l_orderkey * 10 + l_linenumber AS ingest_seq,
         l_discount, l_linestatus, l_suppkey, l_quantity, l_linenumber
  FROM lineitem
),
rows AS (
  SELECT snapshot_ts, product_sku, size_name, ingest_seq, 0 AS k, CAST(l_suppkey AS INTEGER) AS warehouse_wb_id,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM listed WHERE l_discount <> 0
  UNION ALL
  SELECT snapshot_ts, product_sku, size_name, ingest_seq, 1, CAST(l_suppkey + 1000000 AS INTEGER), l_linenumber
  FROM listed WHERE l_discount <> 0 AND l_linestatus = 'F'
)"""


def _stock_part(name: str):
    return lambda spark, folder: naive(E.extract_stocks(stock_landing(spark, folder))[name])


STOCK_QUERIES = {
    "stock_sizes": (
        _stock_part("sizes"),
        f"""WITH {_STOCKS}
        SELECT snapshot_ts, product_sku, size_name AS name, alt_name FROM listed
        QUALIFY row_number() OVER (
          PARTITION BY snapshot_ts, product_sku, size_name ORDER BY ingest_seq, alt_name) = 1""",
    ),
    "stock_rows": (
        _stock_part("stocks"),
        f"""WITH {_STOCKS}
        SELECT snapshot_ts, product_sku, size_name, warehouse_wb_id, quantity FROM rows
        QUALIFY row_number() OVER (
          PARTITION BY snapshot_ts, product_sku, size_name, warehouse_wb_id ORDER BY ingest_seq, k, quantity) = 1""",
    ),
    "stock_warehouses": (
        _stock_part("warehouses"),
        f"""WITH {_STOCKS}
        SELECT DISTINCT snapshot_ts, warehouse_wb_id AS wb_id, CAST(NULL AS VARCHAR) AS name FROM rows""",
    ),
}


# --- sellers ----------------------------------------------------------------------------------------------


def seller_landing(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    segment = c("c_mktsegment")
    body = F.to_json(
        F.struct(
            c("c_nationkey").alias("supplierId"),
            F.when(segment == "HOUSEHOLD", "").otherwise(c("c_name")).alias("supplierName"),
            F.when(segment.isin("HOUSEHOLD", "BUILDING"), "").when(segment != "MACHINERY", segment).alias("trademark"),
            F.when(c("c_acctbal") < 5000, F.concat(F.lit("inn "), c("c_custkey"))).alias("inn"),
            c("c_name").alias("legalAddress"),
        )
    )
    return as_landing(
        table(spark, folder, "customer"),
        endpoint=F.lit("seller"), sku=c("c_custkey"),
        code=F.when(c("c_acctbal") < 0, 404).otherwise(200), body=body,
        snapshot_ts=F.lit("2024-01-01 00:00:00"), ingest_seq=c("c_custkey"),
    )


_SELLERS = """
named AS (
  SELECT TIMESTAMP '2024-01-01' AS snapshot_ts, CAST(c_custkey AS INTEGER) AS sku, c_custkey AS ingest_seq,
         c_nationkey AS wb_id,
         coalesce(nullif(CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN ''
                              WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END, ''),
                  nullif(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_name END, '')) AS name,
         CASE WHEN c_acctbal < 5000 THEN 'inn ' || c_custkey END AS inn, c_name AS address
  FROM customer WHERE c_acctbal >= 0
),
found AS (SELECT * FROM named WHERE name IS NOT NULL)"""


def product_seller(spark, folder):
    """Parts bound to the seller found for their key; without a reply or a name it stays null."""
    products = table(spark, folder, "part").select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("snapshot_ts"), F.col("p_partkey").cast("int").alias("sku"), "p_name"
    )
    return naive(E.with_seller(products, E.sellers_by_sku(E.parse_sellers(seller_landing(spark, folder)))))


SELLER_QUERIES = {
    "seller_name_default": (
        lambda spark, folder: naive(E.sellers_by_sku(E.parse_sellers(seller_landing(spark, folder))).drop("ogrn", "ogrnip")),
        f"WITH {_SELLERS} SELECT snapshot_ts, sku, ingest_seq, wb_id, name, inn, address FROM found",
    ),
    "sellers": (
        lambda spark, folder: naive(E.extract_sellers(E.sellers_by_sku(E.parse_sellers(seller_landing(spark, folder))))),
        f"""WITH {_SELLERS}
        SELECT snapshot_ts, wb_id, name, 'https://images.wbstatic.net/shops/' || wb_id || '_logo.jpg' AS image_url,
               inn, CAST(NULL AS VARCHAR) AS ogrn, CAST(NULL AS VARCHAR) AS ogrnip, address
        FROM found QUALIFY row_number() OVER (PARTITION BY wb_id ORDER BY ingest_seq) = 1""",
    ),
    "product_seller": (
        product_seller,
        f"""WITH {_SELLERS}
        SELECT TIMESTAMP '2024-01-01' AS snapshot_ts, CAST(p_partkey AS INTEGER) AS sku, p_name, wb_id AS seller_wb_id
        FROM part LEFT JOIN found ON found.sku = p_partkey""",
    ),
}


# --- menus, queries, catalogs -----------------------------------------------------------------------------


def menu_landing(spark: SparkSession, folder: str) -> DataFrame:
    """One menu per customer: segment, below it the customer, below that an offer."""
    c = F.col
    offer = F.struct(
        F.lit("offer").alias("name"), F.lit("/catalog/offer").alias("url"),
        F.when(c("c_nationkey") != 7, "o").alias("shard"), F.concat(F.lit("n="), c("c_nationkey")).alias("query"),
    )
    own = F.struct(
        c("c_name").alias("name"),
        F.when(c("c_acctbal") < 0, "/promo").otherwise("/catalog/c").alias("url"),
        F.lit("c").alias("shard"),
        F.when(c("c_nationkey") == 3, F.lit(False)).alias("landing"),
        F.array(offer).alias("childs"),
    )
    root = F.struct(
        c("c_mktsegment").alias("name"), F.lit("/catalog").alias("url"),
        F.concat(F.lit("m"), c("c_nationkey")).alias("shard"), F.array(own).alias("childs"),
    )
    return as_landing(
        table(spark, folder, "customer"),
        endpoint=F.lit("categories"), code=F.lit(200), body=F.to_json(F.array(root)),
        snapshot_ts=F.lit("2024-01-01 00:00:00"), ingest_seq=c("c_custkey"),
    )


_MENU = """
menu AS (
  SELECT c_mktsegment AS text, '/catalog' AS url, 'm' || c_nationkey AS shard, CAST(NULL AS VARCHAR) AS query,
         c_custkey AS ingest_seq FROM customer
  UNION ALL
  SELECT c_mktsegment || '/' || c_name, '/catalog/c', 'c', NULL, c_custkey
  FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 3
  UNION ALL
  SELECT c_mktsegment || '/' || c_name || '/offer', '/catalog/offer', 'o', 'n=' || c_nationkey, c_custkey
  FROM customer WHERE c_nationkey <> 7
),
categories AS (
  SELECT * FROM menu QUALIFY row_number() OVER (PARTITION BY text ORDER BY ingest_seq) = 1
)"""


def query_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of whole documents as query lists of a category, words of messages as those of a text."""
    c = F.col
    words = F.split("text", " ", -1)
    documents = as_landing(
        table(spark, folder, "documents"),
        endpoint=F.lit("queries"), source_kind=F.lit("category"), source_text=c("source"), code=F.lit(200),
        body=F.to_json(words), snapshot_ts=F.lit("2024-01-01 00:00:00"), ingest_seq=c("doc_id"),
    )
    messages = as_landing(
        table(spark, folder, "conversations"),
        endpoint=F.lit("queries"), source_kind=F.lit("query"), source_text=c("role"), code=F.lit(200),
        body=F.to_json(F.struct(words.alias("query"))), snapshot_ts=F.lit("2024-01-01 00:00:00"),
        ingest_seq=c("conv_id"),
    )
    return documents.unionByName(messages)


NON_INTEGER_TEXT_SQL = r"""
WITH words AS (
  SELECT 'category' AS source_kind, source AS source_text, unnest(string_split(text, ' ')) AS text FROM documents
  UNION ALL
  SELECT 'query', role, unnest(string_split(text, ' ')) FROM conversations
)
SELECT DISTINCT source_kind, source_text, text FROM words
WHERE text <> ''
  AND NOT (regexp_full_match(text, '[+-]?[0-9]+') AND TRY_CAST(replace(text, '+', '') AS INTEGER) IS NOT NULL)
"""


def catalog_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog replies by search text; pending orders stand for failed requests."""
    c = F.col
    body = F.to_json(
        F.struct(
            F.when(c("o_orderstatus") == "F", "presets/bucket").otherwise("home").alias("shardKey"),
            F.concat(F.lit("cat="), c("o_custkey") % 100).alias("query"),
        )
    )
    return as_landing(
        table(spark, folder, "orders"),
        endpoint=F.lit("catalog"), source_text=F.concat_ws(" ", "o_orderpriority", "o_custkey"),
        code=F.when(c("o_orderstatus") == "P", 500).otherwise(200), body=body,
        snapshot_ts=F.lit("2024-01-01 00:00:00"), ingest_seq=c("o_orderkey"),
    )


def source_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Menus, query lists and catalog replies that belong together.

    A customer's category has three queries; the customer's own name is one without a catalog reply.
    """
    c = F.col
    customers = table(spark, folder, "customer")
    when = F.lit("2024-01-01 00:00:00")
    own = F.concat_ws("/", "c_mktsegment", "c_name")
    lists = as_landing(
        customers, endpoint=F.lit("queries"), source_kind=F.lit("category"), source_text=own, code=F.lit(200),
        body=F.to_json(F.array(c("c_name"), F.lit("12"), F.concat(F.lit("hat "), c("c_nationkey")))),
        snapshot_ts=when, ingest_seq=c("c_custkey"),
    )

    def catalog(rows, text, shard, query, seq):
        body = F.to_json(F.struct(shard.alias("shardKey"), query.alias("query")))
        return as_landing(
            rows, endpoint=F.lit("catalog"), source_text=text, code=F.lit(200), body=body, snapshot_ts=when,
            ingest_seq=seq,
        )

    return (
        menu_landing(spark, folder).unionByName(lists)
        .unionByName(catalog(customers, own, F.lit("c"), F.concat(F.lit("n="), c("c_nationkey")), c("c_custkey")))
        .unionByName(
            catalog(
                table(spark, folder, "nation"), F.concat(F.lit("hat "), c("n_nationkey")), F.lit("presets/h"),
                F.concat(F.lit("r="), c("n_regionkey")), c("n_nationkey"),
            )
        )
    )


_SOURCES = f"""{_MENU},
own AS (SELECT c.*, c_mktsegment || '/' || c_name AS own_text FROM customer c),
sources AS (
  SELECT 'category' AS kind, text FROM categories
  UNION ALL
  SELECT DISTINCT 'query', q FROM (
    SELECT own_text, unnest([c_name, 'hat ' || c_nationkey]) AS q FROM own
  ) WHERE own_text IN (SELECT text FROM categories)
),
resolved AS (
  SELECT own_text AS text, 'c' AS shard, 'n=' || c_nationkey AS query FROM own
  UNION ALL
  SELECT 'hat ' || n_nationkey, 'presets/h', 'r=' || n_regionkey FROM nation
),
bound AS (SELECT s.*, r.shard, r.query FROM sources s LEFT JOIN resolved r USING (text))"""


def _source_part(name: str):
    def query(spark, folder):
        return E.category_bundle(E.source_catalogs(source_landing(spark, folder)))[name].drop("snapshot_ts")

    return query


def request_urls(spark, folder):
    """Urls of every request kind for every part."""
    c = F.col
    kind = F.when(c("p_size") > 25, "category").otherwise("query")
    shard = F.when(c("p_size") > 40, "presets/p").when(c("p_size") > 30, "merger1").otherwise(c("p_type"))
    return table(spark, folder, "part").select(
        "p_partkey", catalog_url(c("p_name")).alias("catalog_url"),
        page_url(shard, F.concat(F.lit("brand="), c("p_brand")), c("p_size")).alias("page_url"),
        queries_url(kind, c("p_name"), F.concat(F.lit("/catalog/"), c("p_type"))).alias("queries_url"),
        seller_url(c("p_partkey").cast("int")).alias("seller_url"),
    )


REQUEST_URLS_SQL = f"""
SELECT p_partkey,
  'https://search.wb.ru/exactmatch/ru/common/v4/search?resultset=dummy&query=' || replace(p_name, ' ', '+')
    AS catalog_url,
  CASE WHEN p_size > 30
    THEN 'https://search.wb.ru/' || CASE WHEN p_size > 40 THEN 'presets/p' ELSE 'merger1' END
      || '/catalog?dest=-1029256,-2095259,-369838,-1784077&locale=ru&limit=300&brand=' || p_brand || '&page=' || p_size
    ELSE 'https://catalog.wb.ru/catalog/' || p_type || '/catalog?locale=ru&limit=300&brand=' || p_brand
      || '&page=' || p_size END AS page_url,
  CASE WHEN p_size > 25 THEN 'https://similar-queries.wildberries.ru/catalog?url=/catalog/' || p_type
    ELSE 'https://similar-queries.wildberries.ru/api/v2/search/query?query=' || replace(p_name, ' ', '+')
      || '&regions=68,64,83,4,38,80,33,70,82,86,30,69,1,48,22,66,31,40&locale=ru&lang=ru'
      || '&dest=-1029256,-2095259,-369838,-1784077' END AS queries_url,
  'https://basket-' || {bucket_sql('p_partkey')} || '.wb.ru/vol' || p_partkey // 100000 || '/part'
    || p_partkey // 1000 || '/' || p_partkey || '/info/sellers.json' AS seller_url
FROM part
"""

SOURCE_QUERIES = {
    "category_paths": (
        lambda spark, folder: naive(E.extract_categories(menu_landing(spark, folder))),
        f"""WITH {_MENU}
        SELECT TIMESTAMP '2024-01-01' AS snapshot_ts, ingest_seq, text, url, shard, query FROM categories""",
    ),
    "non_integer_text": (
        lambda spark, folder: E.extract_queries(query_landing(spark, folder)).select(
            "source_kind", "source_text", "text"
        ),
        NON_INTEGER_TEXT_SQL,
    ),
    "catalog_resolve": (
        lambda spark, folder: E.extract_catalogs(catalog_landing(spark, folder)).drop("snapshot_ts"),
        """SELECT o_orderpriority || ' ' || o_custkey AS source_text,
                  CASE WHEN o_orderstatus = 'F' THEN 'presets/bucket' ELSE 'home' END AS shard,
                  'cat=' || o_custkey % 100 AS query, o_orderkey AS ingest_seq
           FROM orders WHERE o_orderstatus <> 'P'
           QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderkey) = 1""",
    ),
    "accepted_codes": (
        lambda spark, folder: replies(catalog_landing(spark, folder), "catalog").select("ingest_seq", "source_text"),
        """SELECT o_orderkey AS ingest_seq, o_orderpriority || ' ' || o_custkey AS source_text
           FROM orders WHERE o_orderstatus <> 'P'""",
    ),
    "refused_codes": (
        lambda spark, folder: refused_replies(catalog_landing(spark, folder)).drop("snapshot_ts"),
        """SELECT 'landing' AS stage, 'code 500 for catalog' AS reason,
                  o_orderpriority || ' ' || o_custkey AS request, o_orderkey AS ingest_seq
           FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "source_union": (
        lambda spark, folder: E.source_catalogs(source_landing(spark, folder)).select("kind", "text", "shard", "query"),
        f"WITH {_SOURCES} SELECT kind, text, shard, query FROM bound",
    ),
    "source_catalogs": (
        _source_part("catalogs"),
        f"WITH {_SOURCES} SELECT DISTINCT shard, query FROM bound WHERE shard IS NOT NULL",
    ),
    "source_categories": (
        _source_part("categories"),
        f"""WITH {_SOURCES} SELECT text, shard AS catalog_shard, query AS catalog_query
        FROM bound WHERE kind = 'category' AND shard IS NOT NULL""",
    ),
    "source_queries": (
        _source_part("queries"),
        f"""WITH {_SOURCES} SELECT text, shard AS catalog_shard, query AS catalog_query
        FROM bound WHERE kind = 'query' AND shard IS NOT NULL""",
    ),
    "request_url": (request_urls, REQUEST_URLS_SQL),
}

QUERIES = {**PAGE_QUERIES, **STOCK_QUERIES, **SELLER_QUERIES, **SOURCE_QUERIES}
