"""Declarations of the thirteen tables.

Facts carry natural keys (sku, size name, warehouse id) instead of surrogate ids, so the foreign keys of
a table become ``Lookup`` checks against the dictionaries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "string": T.StringType(),
}


def _struct(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


@dataclass(frozen=True)
class Lookup:
    """A staged key that has to exist in a dictionary.

    ``on`` maps staged columns to dictionary columns. An unresolved optional lookup sets the staged columns
    to null; an unresolved required one rejects the row. ``parent`` is checked on the dictionary's own rows,
    which are far fewer than the staged ones.
    """

    dictionary: str
    on: dict[str, str]
    required: bool = True
    parent: Lookup | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str  # "dictionary" or "history"
    staging: T.StructType
    key: tuple[str, ...]
    lookups: tuple[Lookup, ...] = field(default=())
    nullable: tuple[str, ...] = field(default=())
    # Order of the one-row-per-key choice inside a load; the rest of the row is the tie-breaker.
    nulls_last_order: tuple[str, ...] = field(default=())

    @property
    def is_history(self) -> bool:
        return self.kind == "history"

    @property
    def final(self) -> T.StructType:
        """Stored schema: dictionaries rename the snapshot time to ``last_timestamp``."""
        if self.is_history:
            return self.staging
        return T.StructType(
            [
                T.StructField("last_timestamp", f.dataType) if f.name == "timestamp" else f
                for f in self.staging.fields
            ]
        )

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.staging.fields if f.name not in self.nullable)


_CATALOG = Lookup("catalogs", {"catalog_shard": "shard", "catalog_query": "query"})
_PRODUCT = Lookup("products", {"product_sku": "sku"})
# product, then size of that product: the product is looked up from the size, so facts join once for both.
_MERCH = (
    Lookup("sizes", {"product_sku": "product_sku", "size_name": "name"}, parent=_PRODUCT),
    Lookup("warehouses", {"warehouse_wb_id": "wb_id"}),
)
_MERCH_KEY = ("product_sku", "size_name", "warehouse_wb_id", "timestamp")
_STOCK_DDL = "product_sku int, size_name string, warehouse_wb_id int, quantity int"

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "catalogs", "dictionary",
            _struct("timestamp timestamp, shard string, query string"),
            ("shard", "query"),
        ),
        TableSpec(
            "categories", "dictionary",
            _struct("timestamp timestamp, text string, catalog_shard string, catalog_query string"),
            ("text",), (_CATALOG,),
        ),
        TableSpec(
            "queries", "dictionary",
            _struct("timestamp timestamp, text string, catalog_shard string, catalog_query string"),
            ("text",), (_CATALOG,),
        ),
        TableSpec(
            "brands", "dictionary",
            _struct("timestamp timestamp, wb_id int, name string, image_url string"),
            ("wb_id",),
        ),
        TableSpec(
            "sellers", "dictionary",
            _struct(
                "timestamp timestamp, wb_id int, name string, image_url string, "
                "inn string, ogrn string, ogrnip string, address string"
            ),
            ("wb_id",), nullable=("inn", "ogrn", "ogrnip", "address"),
        ),
        TableSpec(
            "products", "dictionary",
            _struct(
                "timestamp timestamp, sku int, name string, image_url string, "
                "brand_wb_id int, seller_wb_id int"
            ),
            ("sku",),
            (
                Lookup("brands", {"brand_wb_id": "wb_id"}),
                Lookup("sellers", {"seller_wb_id": "wb_id"}, required=False),
            ),
            nullable=("seller_wb_id",),
        ),
        TableSpec(
            "product_details", "history",
            _struct(
                "timestamp timestamp, product_sku int, price int, sale_price int, "
                "feedbacks int, rating short"
            ),
            ("product_sku", "timestamp"), (_PRODUCT,),
        ),
        TableSpec(
            "positions", "history",
            _struct(
                "timestamp timestamp, product_sku int, catalog_shard string, "
                "catalog_query string, place short"
            ),
            ("product_sku", "catalog_shard", "catalog_query", "timestamp"), (_PRODUCT, _CATALOG),
        ),
        TableSpec(
            "sizes", "dictionary",
            _struct("timestamp timestamp, product_sku int, name string, alt_name string"),
            ("product_sku", "name"), (_PRODUCT,),
        ),
        TableSpec(
            "warehouses", "dictionary",
            _struct("timestamp timestamp, wb_id int, name string"),
            ("wb_id",), nullable=("name",), nulls_last_order=("name",),
        ),
        TableSpec(
            "stocks", "history", _struct("timestamp timestamp, " + _STOCK_DDL), _MERCH_KEY, _MERCH,
        ),
        TableSpec(
            "orders", "history",
            _struct("timestamp timestamp, timestamp_to timestamp, " + _STOCK_DDL), _MERCH_KEY, _MERCH,
        ),
        TableSpec(
            "refills", "history",
            _struct("timestamp timestamp, timestamp_to timestamp, " + _STOCK_DDL), _MERCH_KEY, _MERCH,
        ),
    )
}

DICTIONARIES = tuple(n for n, s in TABLES.items() if not s.is_history)
HISTORIES = tuple(n for n, s in TABLES.items() if s.is_history)

# Dictionaries before what refers to them; the tables of one wave do not refer to each other.
FULL_IMPORT_WAVES = (
    ("catalogs", "brands", "sellers", "warehouses"),
    ("categories", "queries", "products"),
    ("product_details", "positions", "sizes"),
    ("stocks",),
)
POINT_IMPORT_WAVES = (("sizes", "warehouses"), ("stocks",))
