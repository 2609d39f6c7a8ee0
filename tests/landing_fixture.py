"""A small marketplace as landing replies."""

import json
import tempfile

from shelfwatch.sources.landing import LANDING, append_landing, read_landing

MENU = [
    {
        "name": "Home", "url": "/catalog/home", "shard": "home1", "query": "cat=1",
        "childs": [
            {"name": "Lamps", "url": "/catalog/home/lamps", "shard": "home2", "query": "cat=2"},
            {
                "name": "Promo", "url": "/promo", "shard": "p", "query": "x",
                "childs": [{"name": "Deep", "url": "/catalog/deep", "shard": "d", "query": "cat=3"}],
            },
            {"name": "Landing", "url": "/catalog/l", "shard": "l", "landing": False},
            {"name": "NoShard", "url": "/catalog/n"},
        ],
    },
    {"name": "Home/Lamps", "url": "/catalog/other", "shard": "other", "query": "cat=9"},
]


def product(sku, brand=1, price=19900, sale=14950, rating=5, feedbacks=7, name=None, **more):
    return {
        "id": sku, "name": f"item {sku}" if name is None else name, "brand": f"brand {brand}", "brandId": brand,
        "priceU": price, "salePriceU": sale, "rating": rating, "feedbacks": feedbacks, **more,
    }


def page_body(*products):
    return json.dumps({"data": {"products": list(products)}})


def stocks_body(*entries):
    """entries: (sku, size, {warehouse: quantity})"""
    return json.dumps(
        {
            "data": {
                "products": [
                    {
                        "id": sku,
                        "sizes": [
                            {
                                "name": f"alt {size}", "origName": size,
                                "stocks": [{"wh": w, "qty": q} for w, q in levels.items()],
                            }
                        ],
                    }
                    for sku, size, levels in entries
                ]
            }
        }
    )


class Replies:
    def __init__(self, ts):
        self.ts = ts
        self.rows = []

    def add(self, endpoint, body, code=200, **key):
        row = {f.name: None for f in LANDING.fields}
        row.update(endpoint=endpoint, body=body, code=code, snapshot_ts=self.ts, ingest_seq=len(self.rows), **key)
        self.rows.append(tuple(row[f.name] for f in LANDING.fields))
        return self

    def frame(self, spark):
        """The replies as a Parquet landing table, as a job reads them."""
        path = tempfile.mkdtemp(prefix="landing-")
        append_landing(spark.createDataFrame(self.rows, LANDING).coalesce(1), path)
        return read_landing(spark, path)


def full_replies(ts, levels):
    """Menu, one query, one catalog with two products, sellers, and the given stock levels."""
    r = Replies(ts)
    r.add("categories", json.dumps(MENU[:1]))
    for text in ("Home", "Home/Lamps", "Home/Promo/Deep"):
        r.add("queries", json.dumps(["red hat", "12", ""]), source_text=text, source_kind="category")
    for text, shard, query in (
        ("Home", "home1", "cat=1"), ("Home/Lamps", "home2", "cat=2"), ("Home/Promo/Deep", "home1", "cat=1"),
        ("red hat", "presets/bucket_1", "preset=1"),
    ):
        r.add("catalog", json.dumps({"shardKey": shard, "query": query}), source_text=text)
    r.add("page", page_body(product(101), product(102, brand=2)), shard="home1", query="cat=1", page=1)
    r.add("page", page_body(), shard="home1", query="cat=1", page=2)
    r.add("page", page_body(product(102, brand=2)), shard="home2", query="cat=2", page=1)
    r.add("seller", json.dumps({"supplierId": 9, "supplierName": "S", "trademark": "", "inn": "7"}), sku=101)
    r.add("seller", None, code=404, sku=102)
    r.add("stocks", stocks_body(*levels))
    return r
