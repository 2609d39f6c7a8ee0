import json

from conftest import at, rows
from landing_fixture import MENU, Replies, page_body, product, stocks_body

from shelfwatch.operators import extract as E
from shelfwatch.sources.landing import LANDING, read_warehouse_file, refused_replies, replies

TS = at(1)


def test_menu(spark):
    r = Replies(TS).add("categories", json.dumps(MENU)).add("categories", "broken").add(
        "categories", json.dumps([{"name": "x"}]))
    found = rows(E.extract_categories(r.frame(spark)), "text", "url", "query")
    # The child wins over the later root of the same text; children of /promo are walked; landing false drops.
    assert found == [
        ("Home", "/catalog/home", "cat=1"),
        ("Home/Lamps", "/catalog/home/lamps", "cat=2"),
        ("Home/Promo/Deep", "/catalog/deep", "cat=3"),
    ]
    assert rows(E.categories_rejects(r.frame(spark)), "reason") == [
        ("missing or inexact: url",), ("unreadable body",),
    ]


def test_child_wins_over_parent_and_elder_over_younger(spark):
    menu = [
        {"name": "A/B", "url": "/catalog/elder", "shard": "e"},
        {"name": "A", "url": "/catalog/a", "shard": "a", "childs": [
            {"name": "B", "url": "/catalog/younger", "shard": "y"},
            {"name": "", "url": "/catalog/x", "shard": "x", "childs": [{"name": "Z", "url": "/catalog/deep", "shard": "d"}]},
            {"name": "/Z", "url": "/catalog/late", "shard": "l"},
        ]},
    ]
    found = rows(E.extract_categories(Replies(TS).add("categories", json.dumps(menu)).frame(spark)), "text", "shard")
    assert found == [("A", "a"), ("A/", "x"), ("A//Z", "d"), ("A/B", "e")]


def test_queries(spark):
    texts = ["", "12", "+5", " 12 ", "1.5", "99999999999", "red hat", "red hat"]
    r = Replies(TS).add("queries", json.dumps(texts), source_text="A", source_kind="category")
    r.add("queries", json.dumps({"query": ["blue", "7"]}), source_text="t", source_kind="query")
    r.add("queries", "{", source_text="bad", source_kind="category")
    assert rows(E.extract_queries(r.frame(spark)), "source_text", "text") == [
        ("A", " 12 "), ("A", "1.5"), ("A", "99999999999"), ("A", "red hat"), ("t", "blue"),
    ]
    assert rows(E.queries_rejects(r.frame(spark)), "request") == [("category bad",)]


def test_catalogs(spark):
    r = Replies(TS).add("catalog", json.dumps({"query": "q", "shardKey": "s"}), source_text="a")
    r.add("catalog", json.dumps({"query": "late", "shardKey": "s"}), source_text="a")
    r.add("catalog", json.dumps({"query": "q"}), source_text="b")
    assert rows(E.extract_catalogs(r.frame(spark)), "source_text", "shard", "query") == [("a", "s", "q")]
    assert rows(E.catalogs_rejects(r.frame(spark)), "request", "reason") == [("b", "missing or inexact: shard")]


def test_page_rows(spark):
    r = Replies(TS)
    r.add("page", page_body(*[product(1000 + i) for i in range(201)]), shard="s", query="q", page=17)
    r.add("page", page_body(product(1, price=199), product(2, brand=3), product(1, price=500, name="again")),
          shard="s", query="q", page=1)
    r.add("page", page_body(product(9)), shard="s", query="q", page=18)
    r.add("page", page_body(product(9)), shard="s", query="q")
    r.add("page", page_body(product(12.0), product(12.5), product(3000000000), product(77, rating=None)),
          shard="s", query="z", page=1)
    out = E.extract_pages(r.frame(spark))
    places = rows(out["positions"].where("catalog_query = 'q'"), "place", "product_sku")
    assert places[0] == (1, 1) and places[1] == (2, 2) and (5000, 1199) in places and len(places) == 202
    products = {sku for (sku,) in rows(out["products"], "sku")}
    assert 1199 in products and 1200 not in products and 9 not in products and 12 in products
    assert rows(out["product_details"].where("product_sku = 1"), "price", "sale_price") == [(1, 149)]
    assert rows(out["products"].where("sku = 1"), "name") == [("item 1",)]
    assert rows(out["rejects"], "request", "reason") == [
        ("s q", "page out of range"),
        ("s q 18", "page out of range"),
        ("s z 1 place 2", "missing or inexact: sku"),
        ("s z 1 place 3", "missing or inexact: sku"),
        ("s z 1 place 4", "missing or inexact: rating"),
    ]


def test_first_empty_page_stops_a_catalog(spark):
    r = Replies(TS)
    for page, body, code in ((1, page_body(product(1)), 200), (2, page_body(product(2)), 200), (3, "", 200),
                             (4, page_body(product(4)), 200)):
        r.add("page", body, code=code, shard="s", query="a", page=page)
    r.add("page", None, code=404, shard="s", query="b", page=1)
    r.add("page", page_body(product(5)), shard="s", query="b", page=2)
    r.add("page", page_body(product(6)), shard="s", query="c", page=2)
    r.add("page", "not json", shard="s", query="d", page=1)
    r.add("page", page_body(product(7)), shard="s", query="d", page=2)
    out = E.extract_pages(r.frame(spark))
    # An unreadable page is a reject, not an empty page.
    assert rows(out["products"], "sku") == [(1,), (2,), (6,), (7,)]
    assert rows(out["rejects"], "request", "reason") == [("s d 1", "unreadable body")]


def test_sellers(spark):
    r = Replies(TS)
    r.add("seller", json.dumps({"supplierId": 5, "supplierName": "X", "trademark": ""}), sku=1)
    r.add("seller", json.dumps({"supplierId": 5, "supplierName": "X", "trademark": "T", "ogrn": "1"}), sku=2)
    r.add("seller", json.dumps({"supplierId": 6, "supplierName": "", "trademark": None}), sku=3)
    r.add("seller", None, code=404, sku=4)
    r.add("seller", json.dumps({"supplierName": "Y"}), sku=5)
    r.add("seller", "?", sku=6)
    parsed = E.parse_sellers(r.frame(spark))
    by_sku = E.sellers_by_sku(parsed)
    assert rows(by_sku, "sku", "wb_id", "name") == [(1, 5, "X"), (2, 5, "T")]
    assert rows(E.extract_sellers(by_sku), "wb_id", "name", "ogrn") == [(5, "X", None)]
    assert rows(E.sellers_rejects(parsed), "request", "reason") == [
        ("5", "missing or inexact: wb_id"), ("6", "unreadable body"),
    ]


def test_stocks(spark):
    r = Replies(TS).add("stocks", stocks_body((1, "M", {7: 3, 8: 0}), (1, "M", {7: 9}), (2, "L", {})))
    r.add("stocks", "broken")
    r.add("stocks", json.dumps({"data": {"products": [
        {"id": 3}, {"id": 4, "sizes": [{"name": "n", "stocks": []}]},
        {"id": 5, "sizes": [{"name": "n", "origName": "o", "stocks": [{"wh": 1.5, "qty": 2}]}]},
        {"id": 6, "sizes": []},
    ]}}))
    out = E.extract_stocks(r.frame(spark))
    assert rows(out["sizes"], "product_sku", "name", "alt_name") == [
        (1, "M", "alt M"), (2, "L", "alt L"), (5, "o", "n"),
    ]
    assert rows(out["stocks"], "product_sku", "warehouse_wb_id", "quantity") == [(1, 7, 3), (1, 8, 0)]
    assert rows(out["warehouses"], "wb_id", "name") == [(7, None), (8, None)]
    assert rows(out["rejects"], "reason") == [
        ("missing or inexact: origName",), ("missing or inexact: sizes",),
        ("missing or inexact: warehouse_wb_id",), ("unreadable body",),
    ]


def test_warehouse_file(spark, tmp_path):
    data = [{"origid": 1, "warehouse": "Тула".encode().decode("latin-1")}, {"origid": 2, "warehouse": "B"},
            {"origid": 1, "warehouse": "late"}, {"origid": 2.5, "warehouse": "C"}]
    path = tmp_path / "w.json"
    path.write_text(json.dumps({"result": {"resp": {"data": data}}}) + "\n{\"result\": 1}\n")
    body = read_warehouse_file(spark, str(path))
    assert rows(E.extract_warehouses(body)) == [(1, "Тула"), (2, "B")]
    assert E.warehouses_rejects(body).count() == 1


def test_accepted_codes(spark):
    r = Replies(TS)
    for endpoint, code in (("catalog", 200), ("catalog", 404), ("page", 400), ("page", 500), ("seller", 404),
                           ("stocks", 404), ("other", 200), ("queries", None)):
        r.add(endpoint, "", code=code)
    landing = r.frame(spark)
    assert rows(refused_replies(landing), "reason") == [
        ("code 200 for other",), ("code 404 for catalog",), ("code 404 for stocks",), ("code 500 for page",),
        ("code for queries",),
    ]
    assert sum(replies(landing, e).count() for e in ("catalog", "page", "seller", "stocks", "queries")) == 3


def test_a_run_reads_its_own_part_of_the_landing(spark):
    landing = Replies(TS).add("stocks", stocks_body((1, "M", {1: 1}))).add("page", page_body(product(1))).frame(spark)
    wanted = replies(landing.where(landing.snapshot_ts == TS), "stocks")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_ts" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(wanted.inputFiles()) == 2 and wanted.count() == 1
    assert landing.columns == LANDING.names


def test_null_query_text_is_a_reject(spark):
    r = Replies(TS)
    r.add("queries", '["red hat", null]', source_text="a", source_kind="category")
    r.add("queries", "[]", source_text="b", source_kind="category")
    assert rows(E.extract_queries(r.frame(spark)), "source_text", "text") == [("a", "red hat")]
    assert rows(E.queries_rejects(r.frame(spark)), "request", "reason") == [("category a", "null text")]


def test_menu_of_any_depth(spark):
    body = "{}"
    for k in range(120):
        body = '{"name": "n%d", "url": "/catalog/%d", "shard": "s", "query": "q", "childs": [%s]}' % (k, k, body if k else "")
    r = Replies(TS)
    r.add("categories", f"[{body}]")
    assert E.extract_categories(r.frame(spark)).count() == 120
