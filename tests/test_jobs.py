import json
from datetime import timedelta

import pytest
from conftest import at, rows
from landing_fixture import Replies, full_replies, product, page_body, stocks_body

from shelfwatch.plans import jobs
from shelfwatch.plans.jobs import RejectedRows, run_due, run_full, run_point
from shelfwatch.plans.manifest import Manifest
from shelfwatch.sources.warehouse import Warehouse
from shelfwatch.streaming.snapshots import apply_stock_batch
from shelfwatch.tables import TABLES

LEVELS = [(101, "M", {1: 10, 2: 4}), (102, "L", {1: 6})]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


@pytest.fixture
def warehouse_file(tmp_path):
    path = tmp_path / "warehouses.json"
    listed = [{"origid": 1, "warehouse": "Склад".encode().decode("latin-1")}, {"origid": 5, "warehouse": "North"}]
    path.write_text(json.dumps({"result": {"resp": {"data": listed}}}, ensure_ascii=False) + "\nsecond line\n")
    return str(path)


def test_full_run_fills_all_tables(spark, warehouse, warehouse_file):
    ts = at(1)
    run_full(warehouse, full_replies(ts, LEVELS).frame(spark), ts, warehouse_file, strict=True)
    assert rows(warehouse.read("catalogs"), "shard", "query") == [
        ("home1", "cat=1"), ("home2", "cat=2"), ("presets/bucket_1", "preset=1"),
    ]
    assert rows(warehouse.read("categories"), "text", "catalog_shard") == [
        ("Home", "home1"), ("Home/Lamps", "home2"), ("Home/Promo/Deep", "home1"),
    ]
    assert rows(warehouse.read("queries"), "text", "catalog_query") == [("red hat", "preset=1")]
    assert rows(warehouse.read("brands"), "wb_id", "name") == [(1, "brand 1"), (2, "brand 2")]
    assert rows(warehouse.read("sellers"), "wb_id", "name", "inn", "ogrn") == [(9, "S", "7", None)]
    assert rows(warehouse.read("products"), "sku", "brand_wb_id", "seller_wb_id") == [(101, 1, 9), (102, 2, None)]
    assert rows(warehouse.read("product_details"), "product_sku", "price", "sale_price", "rating") == [
        (101, 199, 149, 5), (102, 199, 149, 5),
    ]
    assert rows(warehouse.read("positions"), "product_sku", "catalog_shard", "place") == [
        (101, "home1", 1), (102, "home1", 2), (102, "home2", 1),
    ]
    assert rows(warehouse.read("sizes"), "product_sku", "name", "alt_name") == [
        (101, "M", "alt M"), (102, "L", "alt L"),
    ]
    assert rows(warehouse.read("warehouses"), "wb_id", "name") == [(1, "Склад"), (2, None), (5, "North")]
    assert rows(warehouse.read("stocks"), "product_sku", "size_name", "warehouse_wb_id", "quantity") == [
        (101, "M", 1, 10), (101, "M", 2, 4), (102, "L", 1, 6),
    ]
    assert warehouse.snapshot_times("stocks") == [ts]
    assert warehouse.read("orders").isEmpty() and warehouse.read("refills").isEmpty()


def test_chain_of_runs(spark, warehouse):
    """Full run, point run, and the next day's full run, with orders and refills between them."""
    first, second, third = at(1), at(1, 9), at(2)
    run_full(warehouse, full_replies(first, LEVELS).frame(spark), first)
    point = Replies(second).add("stocks", stocks_body((101, "M", {1: 7, 2: 9}), (999, "M", {1: 3})))
    run_point(warehouse, point.frame(spark), second)
    # 999 is not an active product; 102 is absent from the newer snapshot and gives nothing.
    assert rows(warehouse.read("stocks", lambda t: t == second), "product_sku") == [(101,), (101,)]
    orders = warehouse.read("orders").selectExpr(
        "date_format(timestamp,'ddHH')", "date_format(timestamp_to,'ddHH')", "warehouse_wb_id", "quantity")
    assert rows(orders) == [("0100", "0109", 1, 3)]
    assert rows(warehouse.read("refills"), "warehouse_wb_id", "quantity") == [(2, 5)]
    run_full(warehouse, full_replies(third, [(101, "M", {1: 1, 2: 9})]).frame(spark), third)
    assert warehouse.snapshot_times("orders") == [first, second]
    assert rows(warehouse.at("orders", second), "quantity") == [(6,)]


def test_restart_gives_the_same_tables(spark, warehouse, tmp_path, monkeypatch):
    ts = at(1)
    landing = full_replies(ts, LEVELS).frame(spark)
    whole = Warehouse(spark, str(tmp_path / "whole"))
    run_full(whole, landing, ts)

    load = jobs.SnapshotJob.load

    def failing(self, table, frame, replace=False):
        if table == "positions":
            raise RuntimeError("lost")
        load(self, table, frame, replace)

    monkeypatch.setattr(jobs.SnapshotJob, "load", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_full(warehouse, landing, ts)
    assert Manifest(warehouse).choose(at(1, 7)) == (ts, "full")
    loaded = []
    monkeypatch.setattr(jobs.SnapshotJob, "load", lambda self, t, f, r=False: (loaded.append(t), load(self, t, f, r)))
    run_full(warehouse, landing, ts)
    assert loaded == ["positions", "stocks"]
    for table in TABLES:
        assert rows(warehouse.read(table)) == rows(whole.read(table)), table


def test_due_runs_follow_the_grid(spark, warehouse):
    landing = full_replies(at(1, 3), LEVELS).frame(spark)
    assert run_due(warehouse, landing, at(1, 4), clock=lambda: at(1, 4)) == (at(1, 3), "full")
    assert run_due(warehouse, landing, at(1, 5), clock=lambda: at(1, 5)) is None
    # This run overruns into the 9 o'clock point, which is then left out.
    assert run_due(warehouse, landing, at(1, 6), clock=lambda: at(1, 10)) == (at(1, 6), "point")
    assert Manifest(warehouse).choose(at(1, 10)) is None
    assert Manifest(warehouse).choose(at(1, 12)) == (at(1, 12), "point")
    assert Manifest(warehouse).choose(at(2, 1)) == (at(2), "full")


def test_rejects_are_kept_or_refused(spark, warehouse, tmp_path):
    ts = at(1)
    replies = full_replies(ts, LEVELS)
    replies.add("page", page_body(product(12.5), product(103, name="ok")), shard="home2", query="cat=2", page=2)
    replies.add("stocks", "", code=500)
    replies.add("stocks", stocks_body((777, "S", {1: 1})))
    frame = replies.frame(spark)
    with pytest.raises(RejectedRows):
        run_full(Warehouse(spark, str(tmp_path / "strict")), frame, ts, strict=True)
    run_full(warehouse, frame, ts)
    folder = f"{warehouse.root}/_rejects/day=20240301/point=000000"
    found = rows(spark.read.parquet(f"{folder}/extraction"), "stage", "reason")
    assert found == [("landing", "code 500 for stocks"), ("page", "missing or inexact: sku")]
    assert rows(spark.read.parquet(f"{folder}/sizes"), "product_sku", "reason") == [(777, "unknown in products")]
    assert rows(spark.read.parquet(f"{folder}/stocks"), "product_sku", "reason") == [(777, "unknown in sizes")]
    assert (103,) in rows(warehouse.read("products"), "sku")


def test_upkeep_compacts_and_retains(spark, warehouse):
    days = [at(d, h) for d, h in ((1, 0), (1, 3), (1, 21), (2, 0), (2, 3))]
    levels = [(ts, 101, "M", 1, 20 - 3 * i) for i, ts in enumerate(days)]
    apply_stock_batch(warehouse, spark.createDataFrame(levels, TABLES["stocks"].staging))
    assert warehouse.snapshot_times("stocks") == days
    run_full(warehouse, full_replies(at(3), [(101, "M", {1: 1})]).frame(spark), at(3))
    assert warehouse.snapshot_times("stocks") == [at(1), at(2), at(2, 3), at(3)]
    first_day = warehouse.read("orders", lambda t: t < at(2))
    shown = first_day.selectExpr("date_format(timestamp,'ddHH')", "date_format(timestamp_to,'ddHH')", "quantity")
    assert rows(shown) == [("0100", "0200", 9)]
    histories = ("stocks", "orders", "refills")
    before = {t: rows(warehouse.read(t)) for t in histories}
    assert jobs.compact(warehouse, at(3)) == at(1)
    assert {t: rows(warehouse.read(t)) for t in histories} == before
    # A late snapshot of the compacted day is kept, but its pairs are not derived again.
    jobs.rederive_changes(warehouse, [at(1)], frozen_before=at(2))
    assert rows(warehouse.read("orders")) == before["orders"]
    jobs.retain(warehouse, at(31))
    assert warehouse.snapshot_times("stocks") == [at(1), at(2), at(2, 3), at(3)]
    jobs.retain(warehouse, at(31) + timedelta(days=1))
    assert warehouse.snapshot_times("stocks") == [at(2), at(2, 3), at(3)]
    # Every fact that is left still finds its dictionaries.
    assert rows(warehouse.read("products"), "sku") == [(101,), (102,)]
    jobs.retain(warehouse, at(31) + timedelta(days=3))
    assert warehouse.read("products").isEmpty()
    assert warehouse.snapshot_times("stocks") == []


def test_runs_without_replies(spark, warehouse):
    """Nothing came in: the runs end, and leave empty tables."""
    nothing = full_replies(at(1), LEVELS).frame(spark).where("code = 0")
    run_full(warehouse, nothing, at(1), strict=True)
    run_point(warehouse, nothing, at(1, 3), strict=True)
    assert all(warehouse.read(table).isEmpty() for table in TABLES)
