"""Replies to rows.

Every ``parse_*`` function turns bodies into typed columns once; the bundles built on it are projections of
that parse, so a job writes the parse to its scratch folder and reads it back column by column.
Numbers are parsed as doubles, which hold every 32-bit integer, and narrowed without loss. A row with a missing or inexact required field goes
to the ``rejects`` frame of its bundle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.scalars import (
    exact_int,
    first_non_empty,
    integer_like,
    minor_to_major,
    repair_double_encoding,
)
from shelfwatch.functions.urls import brand_image_url, product_image_url, seller_image_url
from shelfwatch.operators.dedupe import distinct_on
from shelfwatch.session import scratch_folder
from shelfwatch.sources.landing import reject, replies

# Catalog paging and the menu's path rules.
PRODUCTS_PER_PAGE = 300
PAGES_PER_CATALOG = 17
POSITION_PLACE_CAP = 5000
# Rows of catalog keys that may be sent to every task: some ten megabytes.
SENT_ROWS = 100_000
CATEGORY_START = "/catalog"
CATEGORY_SEPARATOR = "/"

_NUMBER = "double"
_BAD = {"columnNameOfCorruptRecord": "_bad"}

CATALOG_BODY = "query string, shardKey string"
PAGE_BODY = (
    f"data struct<products: array<struct<id: {_NUMBER}, name: string, brand: string, brandId: {_NUMBER}, "
    f"priceU: {_NUMBER}, salePriceU: {_NUMBER}, rating: {_NUMBER}, feedbacks: {_NUMBER}>>>"
)
SELLER_BODY = (
    f"supplierId {_NUMBER}, supplierName string, trademark string, inn string, ogrn string, "
    "ogrnip string, legalAddress string, _bad string"
)
STOCKS_BODY = (
    f"data struct<products: array<struct<id: {_NUMBER}, sizes: array<struct<name: string, origName: string, "
    f"stocks: array<struct<wh: {_NUMBER}, qty: {_NUMBER}>>>>>>>"
)
WAREHOUSES_BODY = (
    f"result struct<resp: struct<data: array<struct<origid: {_NUMBER}, warehouse: string>>>>"
)

CATALOG_KEY = ["snapshot_ts", "shard", "query"]


def _any_null(*columns: str) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return missing


def _parsed_once(df: DataFrame, name: str, parse: Column) -> DataFrame:
    """Add a parsed column behind a one-element explode.

    Filters on parsed fields would otherwise be pushed below the parse with a copy of it in each of them.
    """
    return df.select("*", F.explode(F.array(parse)).alias(name))


def _names_of_null(*columns: str) -> Column:
    return F.concat_ws(
        " ", F.lit("missing or inexact:"), *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    )


# --- catalog menu -----------------------------------------------------------------------------------------


def _menu_nodes(landing: DataFrame) -> DataFrame:
    """Every node of every menu; ``walk`` holds the child positions from the root down."""
    menus = replies(landing, "categories").select("snapshot_ts", "ingest_seq", "body")
    return menus.sparkSession.sql(
        """
        WITH RECURSIVE nodes (snapshot_ts, ingest_seq, prefix, walk, node) AS (
          SELECT snapshot_ts, ingest_seq, '', array(CAST(v.pos AS INT)), v.value
          FROM {menus}, LATERAL variant_explode(try_parse_json(body)) v
          UNION ALL
          SELECT snapshot_ts, ingest_seq,
                 concat(prefix, variant_get(node, '$.name', 'string'), :separator),
                 array_append(walk, CAST(v.pos AS INT)), v.value
          FROM nodes, LATERAL variant_explode(variant_get(node, '$.childs', 'variant')) v
        )
        SELECT snapshot_ts, ingest_seq, walk,
               concat(prefix, variant_get(node, '$.name', 'string')) AS text,
               variant_get(node, '$.url', 'string') AS url,
               variant_get(node, '$.shard', 'string') AS shard,
               variant_get(node, '$.query', 'string') AS query,
               variant_get(node, '$.landing', 'string') AS landing
        FROM nodes
        """,
        args={"separator": CATEGORY_SEPARATOR},
        menus=menus,
    )


def parse_menus(landing: DataFrame) -> DataFrame:
    """The walk over all menus, one row per node, and one row without ``walk`` per reply that is no menu."""
    unreadable = replies(landing, "categories").where(
        F.coalesce(F.schema_of_variant(F.try_parse_json("body")), F.lit("")).startswith("ARRAY") == F.lit(False)
    )
    nodes = _menu_nodes(landing).withColumn("problem", F.when(_any_null("text", "url"), _names_of_null("text", "url")))
    return nodes.unionByName(
        unreadable.select("snapshot_ts", "ingest_seq", F.lit("unreadable body").alias("problem")), allowMissingColumns=True
    )


def categories_of(nodes: DataFrame) -> DataFrame:
    """One row per category path of ``parse_menus``.

    Children are walked even below a node that does not qualify. On equal paths the node visited first in
    post-order wins: a child before its parent, an earlier sibling before a later one.
    """
    qualified = nodes.where(
        F.col("text").isNotNull()
        & F.col("url").startswith(CATEGORY_START)
        & F.col("shard").isNotNull()
        & F.col("landing").isNull()
    )
    # A closing mark above any child position sorts a parent after its children.
    post_order = qualified.withColumn("walk", F.array_append("walk", F.lit(2**31 - 1)))
    return distinct_on(post_order, ["snapshot_ts", "text"], ["ingest_seq", "walk"]).select(
        "snapshot_ts", "ingest_seq", "text", "url", "shard", "query"
    )


def menu_rejects(nodes: DataFrame) -> DataFrame:
    request = F.when(F.col("walk").isNotNull(), F.col("text")).otherwise("")
    return reject(nodes.where("problem IS NOT NULL"), "categories", F.col("problem"), request)


def extract_categories(landing: DataFrame) -> DataFrame:
    """Menu tree to one row per category path."""
    return categories_of(parse_menus(landing))


def categories_rejects(landing: DataFrame) -> DataFrame:
    return menu_rejects(parse_menus(landing))


def _query_texts() -> Column:
    """Text list of a queries reply: the root for a category, a member for a text source."""
    body = F.col("body")
    return F.when(F.col("source_kind") == "category", F.from_json(body, "array<string>")).otherwise(
        F.from_json(body, "query array<string>")["query"]
    )


def parse_queries(landing: DataFrame) -> DataFrame:
    """Query replies with their text list, null where the body is no list."""
    return replies(landing, "queries").select(
        "snapshot_ts", "ingest_seq", "source_kind", "source_text", _query_texts().alias("texts")
    )


def queries_of(parsed: DataFrame) -> DataFrame:
    """Query texts per source; empty and integer-like texts are dropped."""
    exploded = parsed.select(
        "snapshot_ts", "source_kind", "source_text", "ingest_seq", F.explode_outer("texts").alias("text")
    ).where((F.col("text") != "") & ~integer_like(F.col("text")))
    # Only the arrival distinguishes rows of one key, so the earliest is a minimum.
    return exploded.groupBy("snapshot_ts", "source_kind", "source_text", "text").agg(F.min("ingest_seq").alias("ingest_seq"))


def query_list_rejects(parsed: DataFrame) -> DataFrame:
    """Unreadable replies, and replies with a null text in their list; their other texts are kept."""
    reason = F.when(F.col("texts").isNull(), "unreadable body").otherwise("null text")
    bad = parsed.where(F.col("texts").isNull() | F.exists("texts", lambda text: text.isNull()))
    return reject(bad, "queries", reason, F.concat_ws(" ", "source_kind", "source_text"))


def extract_queries(landing: DataFrame) -> DataFrame:
    """Query texts per source; empty and integer-like texts are dropped."""
    return queries_of(parse_queries(landing))


def queries_rejects(landing: DataFrame) -> DataFrame:
    return query_list_rejects(parse_queries(landing))


def parse_catalogs(landing: DataFrame) -> DataFrame:
    """Catalog replies with the catalog they name."""
    parsed = _parsed_once(replies(landing, "catalog"), "_json", F.from_json("body", CATALOG_BODY))
    return parsed.select(
        "snapshot_ts", "ingest_seq", "source_text", F.col("_json.shardKey").alias("shard"), F.col("_json.query").alias("query")
    )


def catalogs_of(parsed: DataFrame) -> DataFrame:
    """Catalog a source text resolves to."""
    return distinct_on(
        parsed.where(~_any_null("source_text", "shard", "query")).select("snapshot_ts", "source_text", "shard", "query", "ingest_seq"),
        ["snapshot_ts", "source_text"],
        ["ingest_seq"],
    )


def catalog_reply_rejects(parsed: DataFrame) -> DataFrame:
    required = ("source_text", "shard", "query")
    return reject(
        parsed.where(_any_null(*required)), "catalog", _names_of_null(*required), F.col("source_text")
    )


def extract_catalogs(landing: DataFrame) -> DataFrame:
    """Catalog a source text resolves to."""
    return catalogs_of(parse_catalogs(landing))


def catalogs_rejects(landing: DataFrame) -> DataFrame:
    return catalog_reply_rejects(parse_catalogs(landing))


def bind_sources(categories: DataFrame, queries: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Categories and the queries below them, each with its catalog or null."""
    # A query counts only below a category of the same menu.
    own = queries.where("source_kind = 'category'").join(
        categories.select("snapshot_ts", F.col("text").alias("source_text")),
        ["snapshot_ts", "source_text"],
        "left_semi",
    )
    sources = categories.select(
        "snapshot_ts", F.lit("category").alias("kind"), "text", "ingest_seq"
    ).unionByName(
        own.groupBy("snapshot_ts", "text").agg(F.min("ingest_seq").alias("ingest_seq")).withColumn("kind", F.lit("query"))
    )
    resolved = catalogs.select("snapshot_ts", F.col("source_text").alias("text"), "shard", "query")
    return sources.join(resolved, ["snapshot_ts", "text"], "left")


def source_catalogs(landing: DataFrame) -> DataFrame:
    """Categories and the queries below them, each with its catalog or null."""
    return bind_sources(extract_categories(landing), extract_queries(landing), extract_catalogs(landing))


def category_bundle(bound: DataFrame) -> dict[str, DataFrame]:
    """Catalogs, categories and queries of ``source_catalogs``."""
    known = bound.where(F.col("shard").isNotNull())
    as_source = [
        "snapshot_ts", "text", F.col("shard").alias("catalog_shard"), F.col("query").alias("catalog_query"),
    ]
    return {
        "catalogs": known.select(*CATALOG_KEY).distinct(),
        "categories": known.where("kind = 'category'").select(*as_source),
        "queries": known.where("kind = 'query'").select(*as_source),
        "rejects": reject(
            bound.where(F.col("shard").isNull()), "sources", "no catalog reply", F.col("text")
        ),
    }


# --- catalog pages ----------------------------------------------------------------------------------------


def parse_pages(landing: DataFrame, max_page: int = PAGES_PER_CATALOG) -> DataFrame:
    """Page replies with their product array and its length.

    ``readable`` is false for a body that is not a product list, ``in_range`` for a page that no run asks for;
    such a page lists nothing.
    """
    in_range = F.coalesce(F.col("page").between(1, max_page), F.lit(False))
    has_body = in_range & (F.col("code") == 200) & (F.col("body") != "")
    return (
        replies(landing, "page")
        .select(
            *CATALOG_KEY, "page", "ingest_seq", in_range.alias("in_range"),
            F.coalesce(has_body, F.lit(False)).alias("has_body"),
            F.when(has_body, F.from_json("body", PAGE_BODY)["data"]["products"]).alias("products"),
        )
        .withColumns(
            {
                "readable": ~F.col("has_body") | F.col("products").isNotNull(),
                "listed": F.coalesce(F.size("products"), F.lit(0)),
            }
        )
    )


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a written table below the scratch folder."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Keep = Callable[[DataFrame], DataFrame]


def first_empty_pages(parsed: DataFrame, per_page: int, cap: int, keep: Keep | None = None) -> DataFrame | None:
    """First empty page of the catalogs with replies beyond it, written by ``keep``; None if there are none.

    ``parsed`` is a written table, of which this reads the small columns. Rows beyond the place cap do not count.
    """
    room = F.lit(cap) - (F.col("page") - 1) * per_page
    rows = F.greatest(F.lit(0), F.least(F.col("listed"), room))
    empty = F.col("readable") & (rows == 0)
    # Only catalogs with replies beyond an empty page need the cut; normally there are none.
    cut = (
        parsed.where("in_range").groupBy(*CATALOG_KEY)
        .agg(F.min(F.when(empty, F.col("page"))).alias("_empty"), F.max("page").alias("_last"))
        .where("_empty < _last")
        .select(*[F.col(c).alias(f"_{c}") for c in CATALOG_KEY], "_empty")
    )
    # Written, because every table that is made of the pages reads it.
    cut = keep(cut) if keep else _stored(cut, "cut")
    size = cut.count()
    return (F.broadcast(cut) if size <= SENT_ROWS else cut) if size else None


def before_empty(rows: DataFrame, cut: DataFrame | None) -> DataFrame:
    """Rows of pages up to the first empty one of their catalog."""
    if cut is None:
        return rows
    same = [F.col(c) == F.col(f"_{c}") for c in reversed(CATALOG_KEY)]
    return rows.join(cut, [*same, F.col("page") > F.col("_empty")], "left_anti")


def until_first_empty(parsed: DataFrame, per_page: int, cap: int) -> DataFrame:
    """Pages up to the first empty one of their catalog; rows beyond the place cap do not count."""
    return before_empty(parsed.where("in_range"), first_empty_pages(parsed, per_page, cap))


_PAGE_FIELDS = ("sku", "name", "brand_wb_id", "brand", "price_minor", "sale_price_minor", "rating", "feedbacks")


def page_rows(
    parsed: DataFrame, per_page: int = PRODUCTS_PER_PAGE, cap: int = POSITION_PLACE_CAP, keep: Keep | None = None
) -> DataFrame:
    """One row per listed product with its place in the catalog, required fields not yet checked.

    Products are rows before the cut is joined: checks and the choice of columns go below that join, so only what a table
    is made of moves.
    """
    # The outer form, because the inner one sends a size check, and with it the parse, down to the scan.
    listed = parsed.where("in_range").select(
        *CATALOG_KEY, "page", "ingest_seq", F.posexplode_outer("products").alias("_pos", "_p")
    ).where(F.col("_pos").isNotNull())
    placed = listed.withColumn("place", (F.col("page") - 1) * per_page + F.col("_pos") + 1)
    rows = placed.where(F.col("place") <= cap).select(
        *CATALOG_KEY, "page", "ingest_seq", "place",
        exact_int(F.col("_p.id")).alias("sku"),
        F.col("_p.name").alias("name"),
        exact_int(F.col("_p.brandId")).alias("brand_wb_id"),
        F.col("_p.brand").alias("brand"),
        exact_int(F.col("_p.priceU")).alias("price_minor"),
        exact_int(F.col("_p.salePriceU")).alias("sale_price_minor"),
        exact_int(F.col("_p.rating"), "short").alias("rating"),
        exact_int(F.col("_p.feedbacks")).alias("feedbacks"),
    )
    return before_empty(rows, first_empty_pages(parsed, per_page, cap, keep))


def page_bundle(
    parsed: DataFrame, per_page: int = PRODUCTS_PER_PAGE, cap: int = POSITION_PLACE_CAP, keep: Keep | None = None
) -> dict[str, DataFrame]:
    """Brands, products, details and positions; the first listing of a key wins."""
    rows = page_rows(parsed, per_page, cap, keep)
    good = rows.where(~_any_null(*_PAGE_FIELDS, "shard", "query"))
    first = ["page", "place", "shard", "query", "ingest_seq"]
    unusable = parsed.where(~F.col("readable") | ~F.col("in_range"))
    problem = F.when(F.col("in_range"), "unreadable body").otherwise("page out of range")
    page_request = F.concat_ws(" ", "shard", "query", F.col("page").cast("string"))
    return {
        "brands": distinct_on(
            good.select("snapshot_ts", F.col("brand_wb_id").alias("wb_id"), F.col("brand").alias("name"), *first),
            ["snapshot_ts", "wb_id"], first,
        ).select("snapshot_ts", "wb_id", "name", brand_image_url(F.col("wb_id")).alias("image_url")),
        "products": distinct_on(
            good.select("snapshot_ts", "sku", "name", "brand_wb_id", *first), ["snapshot_ts", "sku"], first
        ).select("snapshot_ts", "sku", "name", product_image_url(F.col("sku")).alias("image_url"), "brand_wb_id"),
        "product_details": distinct_on(
            good.select(
                "snapshot_ts", F.col("sku").alias("product_sku"),
                minor_to_major(F.col("price_minor")).alias("price"),
                minor_to_major(F.col("sale_price_minor")).alias("sale_price"),
                "feedbacks", "rating", *first,
            ),
            ["snapshot_ts", "product_sku"], first,
        ).select("snapshot_ts", "product_sku", "price", "sale_price", "feedbacks", "rating"),
        # The first place of a product in a catalog is its smallest, so a minimum does it.
        "positions": good.groupBy(
            "snapshot_ts", F.col("sku").alias("product_sku"),
            F.col("shard").alias("catalog_shard"), F.col("query").alias("catalog_query"),
        ).agg(F.min("place").cast("short").alias("place")),
        "rejects": reject(
            rows.where(_any_null(*_PAGE_FIELDS, "shard", "query")), "page",
            _names_of_null(*_PAGE_FIELDS, "shard", "query"),
            F.concat_ws(" ", page_request, F.lit("place"), F.col("place").cast("string")),
        ).unionByName(reject(unusable, "page", problem, page_request)),
    }


def extract_pages(landing: DataFrame) -> dict[str, DataFrame]:
    return page_bundle(written_pages(landing))


def written_pages(landing: DataFrame) -> DataFrame:
    """The page parse as a written table below the scratch folder, for the tables that are made of it."""
    return _stored(parse_pages(landing), "pages")


# --- sellers ----------------------------------------------------------------------------------------------


def parse_sellers(landing: DataFrame) -> DataFrame:
    """Seller replies with their fields; a product without a seller (404) is absent."""
    found = replies(landing, "seller").where("code = 200")
    named = _parsed_once(found, "_json", F.from_json("body", SELLER_BODY, _BAD))
    return named.select(
        "snapshot_ts", "sku", "ingest_seq",
        exact_int(F.col("_json.supplierId")).alias("wb_id"),
        first_non_empty(F.col("_json.trademark"), F.col("_json.supplierName")).alias("name"),
        F.col("_json.inn").alias("inn"), F.col("_json.ogrn").alias("ogrn"),
        F.col("_json.ogrnip").alias("ogrnip"), F.col("_json.legalAddress").alias("address"),
        (F.col("body").isNull() | F.col("_json._bad").isNotNull()).alias("unreadable"),
    )


def sellers_by_sku(parsed: DataFrame) -> DataFrame:
    """Seller of each product asked for; products without one are absent."""
    named = parsed.where(F.col("name").isNotNull() & ~_any_null("sku", "wb_id"))
    return distinct_on(named.drop("unreadable"), ["snapshot_ts", "sku"], ["ingest_seq"])


def extract_sellers(by_sku: DataFrame) -> DataFrame:
    return distinct_on(by_sku, ["snapshot_ts", "wb_id"], ["ingest_seq", "sku"]).select(
        "snapshot_ts", "wb_id", "name", seller_image_url(F.col("wb_id")).alias("image_url"),
        "inn", "ogrn", "ogrnip", "address",
    )


def landed_sellers(landing: DataFrame) -> DataFrame:
    """Sellers of the seller replies of a landing."""
    return extract_sellers(sellers_by_sku(parse_sellers(landing)))


def sellers_rejects(parsed: DataFrame) -> DataFrame:
    bad = parsed.where(F.col("unreadable") | (F.col("name").isNotNull() & _any_null("sku", "wb_id")))
    return reject(
        bad, "seller",
        F.when(F.col("unreadable"), F.lit("unreadable body")).otherwise(_names_of_null("sku", "wb_id")),
        F.col("sku").cast("string"),
    )


def with_seller(products: DataFrame, by_sku: DataFrame) -> DataFrame:
    """Bind products to the seller found for their sku; without one it stays null."""
    return products.join(
        by_sku.select("snapshot_ts", "sku", F.col("wb_id").alias("seller_wb_id")), ["snapshot_ts", "sku"], "left"
    )


# --- stocks -----------------------------------------------------------------------------------------------


def parse_stocks(landing: DataFrame) -> DataFrame:
    """One row per listed size, with its stock array; a body without sizes gives one row without ``walk``."""
    parsed = replies(landing, "stocks").select(
        "snapshot_ts", "ingest_seq", F.from_json("body", STOCKS_BODY)["data"]["products"].alias("_products")
    )
    products = parsed.select(
        "snapshot_ts", "ingest_seq",
        F.when(F.col("_products").isNull(), "unreadable body").alias("_problem"),
        F.posexplode_outer("_products").alias("_i", "_product"),
    ).where(F.col("_problem").isNotNull() | F.col("_i").isNotNull())
    sizes = products.select(
        "snapshot_ts", "ingest_seq", "_i",
        exact_int(F.col("_product.id")).alias("product_sku"),
        F.coalesce(
            F.col("_problem"), F.when(F.col("_product.sizes").isNull(), "missing or inexact: sizes")
        ).alias("problem"),
        F.posexplode_outer("_product.sizes").alias("_j", "_size"),
    ).where(F.col("problem").isNotNull() | F.col("_j").isNotNull())
    checked = {"id": F.col("product_sku"), "origName": F.col("_size.origName"), "name": F.col("_size.name"),
               "stocks": F.col("_size.stocks")}
    missing = F.concat_ws(" ", *[F.when(c.isNull(), F.lit(n)) for n, c in checked.items()])
    return sizes.select(
        "snapshot_ts", "ingest_seq", F.array("_i", "_j").alias("walk"), "product_sku",
        F.col("_size.origName").alias("size_name"), F.col("_size.name").alias("alt_name"),
        F.col("_size.stocks").alias("stocks"),
        F.coalesce(
            F.col("problem"), F.when(missing != "", F.concat(F.lit("missing or inexact: "), missing))
        ).alias("problem"),
    )


def _stock_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("problem").isNull()).select(
        "snapshot_ts", "ingest_seq", "product_sku", "size_name", "walk",
        F.posexplode_outer("stocks").alias("_k", "_stock"),
    ).where(F.col("_k").isNotNull()).select(
        "snapshot_ts", "ingest_seq", "product_sku", "size_name", F.array_append("walk", F.col("_k")).alias("walk"),
        exact_int(F.col("_stock.wh")).alias("warehouse_wb_id"),
        exact_int(F.col("_stock.qty")).alias("quantity"),
    )


def stock_bundle(parsed: DataFrame) -> dict[str, DataFrame]:
    """Sizes (kept without stock rows too), warehouses (no name here) and stock rows."""
    rows = _stock_rows(parsed)
    good = rows.where(~_any_null("warehouse_wb_id", "quantity"))
    first = ["ingest_seq", "walk"]
    sizes = parsed.where(F.col("problem").isNull()).select(
        "snapshot_ts", "product_sku", F.col("size_name").alias("name"), "alt_name", *first
    )
    size_request = F.concat_ws(" ", F.col("product_sku").cast("string"), "size_name")
    return {
        "sizes": distinct_on(sizes, ["snapshot_ts", "product_sku", "name"], first).drop(*first),
        "warehouses": good.select("snapshot_ts", F.col("warehouse_wb_id").alias("wb_id")).distinct()
        .withColumn("name", F.lit(None).cast("string")),
        "stocks": distinct_on(
            good, ["snapshot_ts", "product_sku", "size_name", "warehouse_wb_id"], first
        ).select("snapshot_ts", "product_sku", "size_name", "warehouse_wb_id", "quantity"),
        "rejects": reject(parsed.where(F.col("problem").isNotNull()), "stocks", F.col("problem"), size_request)
        .unionByName(
            reject(
                rows.where(_any_null("warehouse_wb_id", "quantity")), "stocks",
                _names_of_null("warehouse_wb_id", "quantity"), size_request,
            )
        ),
    }


def extract_stocks(landing: DataFrame) -> dict[str, DataFrame]:
    return stock_bundle(parse_stocks(landing))


# --- warehouses -------------------------------------------------------------------------------------------


def _listed_warehouses(file_body: DataFrame) -> DataFrame:
    listed = file_body.select(
        F.posexplode(F.from_json("body", WAREHOUSES_BODY)["result"]["resp"]["data"]).alias("_i", "_w")
    )
    return listed.select(
        "_i", exact_int(F.col("_w.origid")).alias("wb_id"),
        repair_double_encoding(F.col("_w.warehouse")).alias("name"),
    )


def extract_warehouses(file_body: DataFrame) -> DataFrame:
    """Warehouse list with repaired names; ``file_body`` holds the first line of the file."""
    usable = _listed_warehouses(file_body).where(~_any_null("wb_id", "name"))
    return distinct_on(usable, ["wb_id"], ["_i"]).drop("_i")


def warehouses_rejects(file_body: DataFrame) -> DataFrame:
    bad = (
        _listed_warehouses(file_body).where(_any_null("wb_id", "name"))
        .withColumns({"snapshot_ts": F.lit(None).cast("timestamp"), "ingest_seq": F.lit(None).cast("bigint")})
    )
    return reject(bad, "warehouses", _names_of_null("wb_id", "name"), F.col("_i").cast("string"))
