"""What large tables need: narrow rows below joins, cuts and lines read once, sorts and writes without needless work."""

from __future__ import annotations

import json
import re
from datetime import timedelta

import pytest
from landing_fixture import Replies, full_replies, page_body, product
from pyspark.sql import functions as F

from shelfwatch.contract import market
from shelfwatch.operators import extract as E
from shelfwatch.operators.dedupe import distinct_on
from shelfwatch.plans import jobs, parsed
from shelfwatch.session import configure, scratch_folder
from shelfwatch.sources.landing import LANDING, append_landing, read_landing
from shelfwatch.sources.staging_text import checked_lines
from shelfwatch.sources.warehouse import Warehouse
from shelfwatch.tables import TABLES
from tests.conftest import at, rows


def _page(page: int, sku: int | None, query: str = "q"):
    listed = {"id": sku, "name": "n", "brand": "b", "brandId": 1, "priceU": 100, "salePriceU": 100, "rating": 1, "feedbacks": 1}
    body = None if sku is None else json.dumps({"data": {"products": [listed]}})
    return ("page", None, None, "c", query, page, None, 404 if sku is None else 200, body, at(1), page)


def test_cut_is_written_once_and_joined_with_the_rows_of_one_table(spark):
    replies = [_page(1, 1), _page(2, None), _page(3, 3), _page(1, 7, "other"), _page(2, 8, "other")]
    parsed = E.written_pages(spark.createDataFrame(replies, LANDING))
    kept = []

    def keep(cut):
        kept.append(E._stored(cut, "cut"))
        return kept[-1]

    bundle = E.page_bundle(parsed, keep=keep)
    assert rows(bundle["products"], "sku") == [(1,), (7,), (8,)]
    assert len(kept) == 1 and kept[0].count() == 1
    plan = bundle["brands"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Generate")
    columns = plan[plan.index("LeftAnti"):].splitlines()[1]
    assert "brand" in columns and "price" not in columns and "feedbacks" not in columns


def test_times_come_last_in_the_sort_of_a_choice(spark):
    frame = spark.createDataFrame([(at(1), 1, 2), (at(1), 1, 1), (at(2), 1, 3)], "snapshot_ts timestamp, sku int, seq int")
    first = distinct_on(frame, ["snapshot_ts", "sku"], ["seq"])
    assert rows(first, "seq") == [(1,), (3,)]
    assert re.search(r"windowspecdefinition\(sku#\d+, snapshot_ts#\d+", first._jdf.queryExecution().optimizedPlan().toString())


def test_lines_are_cut_once(spark):
    spec = TABLES["sizes"]
    texts = ["2024-03-01 00:00:00.0\t1\tS1\t\\N", "2024-03-01 00:00:00.0\tx\tS1\ta", "2024-03-01 00:00:00.0\t1\tS1", "\\N\t2\tS2\tb\\\\"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    kept = []

    def keep(checked):
        kept.append(E._stored(checked, "lines"))
        return kept[-1]

    for whole, stored in zip(checked_lines(lines, spec), checked_lines(lines, spec, keep), strict=True):
        assert whole.schema == stored.schema and rows(whole) == rows(stored)
        assert len(rows(whole)) == 2
    assert len(kept) == 1


def test_few_and_many_snapshots_are_written_side_by_side(spark):
    assert int(configure(spark).conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 18
    for snapshots in (3, 40):
        replies = [(*_page(1, k)[:9], at(1) + timedelta(hours=3 * (k % snapshots)), k) for k in range(200)]
        landing = spark.createDataFrame(replies, LANDING).coalesce(1)
        path = scratch_folder(spark, "landing")
        append_landing(landing, path)
        assert rows(read_landing(spark, path)) == rows(landing)


def test_rejects_of_stock_replies_are_joined_once(spark, tmp_path, monkeypatch):
    plans = {}
    keep = jobs.SnapshotJob._keep_rejects

    def watched(self, name, rejects):
        plans[name] = rejects._jdf.queryExecution().optimizedPlan().toString()
        keep(self, name, rejects)

    monkeypatch.setattr(jobs.SnapshotJob, "_keep_rejects", watched)
    warehouse = Warehouse(spark, str(tmp_path))
    jobs.run_full(warehouse, full_replies(at(1), [(101, "M", {1: 10}), (999, "M", {1: 3})]).frame(spark), at(1))
    assert "Join" not in plans["sizes"] and "Join" not in plans["stocks"]
    folder = f"{tmp_path}/_rejects/day=20240301/point=000000"
    assert rows(spark.read.parquet(f"{folder}/sizes"), "product_sku", "reason") == [(999, "unknown in products")]
    assert rows(spark.read.parquet(f"{folder}/stocks"), "product_sku", "reason") == [(999, "unknown in sizes")]
    assert rows(warehouse.read("stocks"), "product_sku", "quantity") == [(101, 10)]


def test_changed_keys_reload_only_what_looks_them_up(spark, tmp_path, monkeypatch):
    first = full_replies(at(1), [(101, "M", {1: 10})])
    first.rows = [r for r in first.rows if not (r[0] == "page" and r[5] == 2)]
    first.add("page", page_body(product(555, brand=7)), shard="home1", query="cat=1", page=3)
    late = Replies(at(1))
    late.rows = [None] * 100
    late.add("page", page_body(), shard="home1", query="cat=1", page=2)
    late.rows = late.rows[100:]
    second = full_replies(at(2), [(101, "M", {1: 7}), (555, "S", {1: 1})])
    second.rows = [r for r in second.rows if r[0] != "page"]
    second.add("page", page_body(product(101, name="newest")), shard="home1", query="cat=1", page=1)
    frames = [r.frame(spark) for r in (first, second, late)]
    batch, again = Warehouse(spark, str(tmp_path / "batch")), Warehouse(spark, str(tmp_path / "again"))
    jobs.run_full(batch, frames[0].unionByName(frames[2]), at(1))
    jobs.run_full(batch, frames[1], at(2))
    path = str(tmp_path / "landing")
    for frame in frames[:2]:
        append_landing(frame, path)
    for ts in (at(1), at(2)):
        jobs.run_full(again, read_landing(spark, path), ts)
    append_landing(frames[2], path)
    loads = []
    load = jobs.SnapshotJob.load

    def watched(self, table, *args):
        loads.append((self.ts, table))
        load(self, table, *args)

    monkeypatch.setattr(jobs.SnapshotJob, "load", watched)
    assert jobs.catch_up(again, read_landing(spark, path)) == [at(1), at(2)]
    # A brand went too, so products count; sources, brands, sellers and warehouses don't.
    assert {t for ts, t in loads if ts == at(2)} == {"products", "product_details", "positions", "sizes", "stocks"}
    for table in TABLES:
        assert rows(again.read(table)) == rows(batch.read(table)), table
    assert jobs.catch_up(again, read_landing(spark, path)) == []


def test_lost_rerun_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "landing")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    append_landing(full_replies(at(1), [(101, "M", {1: 10})]).frame(spark), path)
    jobs.run_full(warehouse, read_landing(spark, path), at(1))
    append_landing(Replies(at(1)).add("seller", '{"supplierId": 8, "supplierName": "L"}', sku=102).frame(spark), path)
    with monkeypatch.context() as lost:
        lost.setattr(jobs.SnapshotJob, "load_all", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.catch_up(warehouse, read_landing(spark, path))
    assert jobs.catch_up(warehouse, read_landing(spark, path)) == [at(1)]


def test_parsed_replies_are_compared_only_if_there_are_more(spark, tmp_path, monkeypatch):
    replies = spark.createDataFrame([_page(k, k) for k in (1, 2)], LANDING)
    more = replies.unionByName(spark.createDataFrame([_page(3, 3), _page(3, 3)], LANDING))
    calls = []
    compare = parsed.pending
    monkeypatch.setattr(parsed, "pending", lambda work, *rest: (calls.append(work.columns), compare(work, *rest))[1])
    kept = parsed.ParsedReplies(Warehouse(spark, str(tmp_path)), at(1))

    def take(frame):
        return rows(kept.take("page", frame, lambda todo: todo.select("page", "body")), "page")

    assert take(replies) == take(replies) == [(1,), (2,)] and calls == []
    assert take(more) == take(more) == [(1,), (2,), (3,), (3,)] and calls == [["unit"]]


def test_pages_of_the_market_are_dealt_out_evenly(spark, tmp_path):
    ids = spark.range(1, 401)
    tables = {
        "region": spark.range(2).selectExpr("id AS r_regionkey", "concat('A', id) AS r_name"),
        "nation": spark.range(5).selectExpr("id AS n_nationkey", "id % 2 AS n_regionkey", "concat('N', id) AS n_name"),
        "part": ids.selectExpr(
            "id AS p_partkey", "'p' AS p_name", "'b' AS p_brand", "'t' AS p_type", "cast(id % 50 AS int) AS p_size", "1.5D AS p_retailprice"
        ),
        "lineitem": ids.selectExpr(
            "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "2.0D AS l_quantity", "'O' AS l_linestatus", "'A' AS l_returnflag"
        ),
    }
    for name, frame in tables.items():
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    landing = market.market_landing(spark, str(tmp_path)).where("endpoint = 'page' AND code = 200")
    sizes = landing.groupBy("snapshot_ts", F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    for snapshot in {r.snapshot_ts for r in sizes}:
        mine = [r.n for r in sizes if r.snapshot_ts == snapshot]
        assert len(mine) >= 4 and max(mine) < 0.5 * sum(mine)
