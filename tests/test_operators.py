import random
from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shelfwatch.operators.batches import sku_batches
from shelfwatch.operators.changes import (
    first_snapshot, history_changes, neighbour_pairs, next_snapshots, previous_snapshot, snapshot_changes,
    split_changes,
)
from shelfwatch.operators.compact import compact_changes, compaction_day
from shelfwatch.operators.dedupe import distinct_on, merge_by_key, nulls_last, pending
from shelfwatch.operators.resolve import resolve
from shelfwatch.operators.retention import keep_days_since, keep_seen_since, retention_edge
from shelfwatch.sources.staging_text import from_lines, read_staging_text, stored_catalogs, to_lines, write_staging_text
from shelfwatch.tables import TABLES

STOCK = "timestamp timestamp, product_sku int, size_name string, warehouse_wb_id int, quantity int"


def stocks(spark, *entries):
    """entries: (sku, time, quantity)"""
    return spark.createDataFrame([(t, k, "M", 1, q) for k, t, q in entries], STOCK)


def changed(df):
    return rows(df.select(F.date_format("timestamp", "ddHH"), F.date_format("timestamp_to", "ddHH"), "product_sku", "diff"))


T1, T2, T3 = at(1, 21), at(2), at(2, 6)


def test_changes_of_a_pair(spark):
    old = stocks(spark, (1, T1, 10), (2, T1, 4), (3, T1, 5), (4, T1, 1))
    new = stocks(spark, (1, T2, 7), (2, T2, 9), (3, T2, 5), (5, T2, 8))
    found = snapshot_changes(old, new)
    assert changed(found) == [("0121", "0200", 1, -3), ("0121", "0200", 2, 5)]
    orders, refills = split_changes(found)
    assert rows(orders, "product_sku", "quantity") == [(1, 3)]
    assert rows(refills, "product_sku", "quantity") == [(2, 5)]


def test_partner_is_the_next_snapshot_of_the_table(spark):
    history = stocks(spark, (1, T1, 10), (1, T3, 2), (2, T1, 4), (2, T2, 1), (2, T3, 1))
    pairs = next_snapshots(history.select("timestamp"))
    assert changed(history_changes(history, pairs)) == [("0121", "0200", 2, -3)]


def test_no_changes_give_empty_frames(spark):
    same = snapshot_changes(stocks(spark, (1, T1, 3)), stocks(spark, (1, T2, 3)))
    assert all(f.isEmpty() for f in split_changes(same))


def brute_changes(history):
    by_time = {}
    for k, t, q in history:
        by_time.setdefault(t, {})[k] = q
    times = sorted(by_time)
    return sorted(
        (a, b, k, by_time[b][k] - q)
        for a, b in zip(times, times[1:])
        for k, q in by_time[a].items()
        if k in by_time[b] and by_time[b][k] != q
    )


def test_history_matches_brute_force_and_balances(spark):
    rng = random.Random(7)
    history = [(k, at(1 + p // 8, p % 8 * 3), rng.randint(0, 4)) for p in range(12) for k in range(9) if rng.random() < 0.7]
    rng.shuffle(history)
    frame = stocks(spark, *history)
    found = history_changes(frame, next_snapshots(frame.select("timestamp")))
    got = sorted((r.timestamp.astimezone(T1.tzinfo), r.timestamp_to.astimezone(T1.tzinfo), r.product_sku, r["diff"]) for r in found.collect())
    assert got == brute_changes(history)
    # old - orders + refills = new, which the signed difference says directly
    quantity = {(k, t): q for k, t, q in history}
    assert all(quantity[k, a] + d == quantity[k, b] for a, b, k, d in got)


def test_bounds(spark):
    frame = stocks(spark, (1, T1, 1), (1, T2, 1), (1, T3, 1))
    show = lambda df: df.select(F.date_format("timestamp", "ddHH")).first()[0]
    assert show(previous_snapshot(frame, F.lit(T3))) == "0200"
    assert show(first_snapshot(frame, F.lit(T2))) == "0200"
    assert show(previous_snapshot(frame, F.lit(T1))) is None


def test_neighbour_pairs():
    assert neighbour_pairs([T3, T1, T2], [T2]) == [(T1, T2), (T2, T3)]
    assert neighbour_pairs([T1], [T1]) == []


def test_compaction_sums_per_key_and_repeats(spark):
    schema = "timestamp timestamp, timestamp_to timestamp, product_sku int, size_name string, warehouse_wb_id int, quantity int"
    facts = spark.createDataFrame(
        [(at(1, 3), at(1, 6), 1, "M", 1, 2), (at(1, 6), at(1, 9), 1, "M", 1, 5), (at(1, 21), at(2), 2, "M", 1, 1)], schema)
    once = compact_changes(facts)
    shown = once.select(F.date_format("timestamp", "ddHH"), F.date_format("timestamp_to", "ddHH"), "product_sku", "quantity")
    assert rows(shown) == [("0103", "0109", 1, 7), ("0121", "0200", 2, 1)]
    assert rows(compact_changes(once)) == rows(once)
    huge = spark.createDataFrame([(at(1), at(2), 1, "M", 1, 2**31 - 1)] * 2, schema)
    with pytest.raises(Exception, match="OVERFLOW"):
        compact_changes(huge).collect()


def test_compaction_day():
    today = at(10)
    assert compaction_day([at(5, 3), at(8), at(9), at(9, 3), today], today).start == at(8)
    chosen = compaction_day([at(5, 3), at(5, 9), at(9)], today)
    assert (chosen.start, chosen.end, chosen.first_snapshot) == (at(5), at(6), at(5, 3))
    assert compaction_day([at(9), at(9, 6)], today) is None
    assert compaction_day([], today) is None


def test_retention_edges(spark):
    edge = retention_edge(at(31))
    assert edge == at(1)
    seen = spark.createDataFrame([(1, edge), (2, edge - timedelta(seconds=1))], "k int, last_timestamp timestamp")
    assert rows(keep_seen_since(seen, F.lit(edge)), "k") == [(1,)]
    assert rows(keep_days_since(seen.withColumnRenamed("last_timestamp", "timestamp"), F.lit(edge)), "k") == [(1,)]


def test_distinct_on(spark):
    names = spark.createDataFrame([(1, None), (1, "B"), (1, "A"), (2, None), (2, None)], "wb_id int, name string")
    assert rows(distinct_on(names, ["wb_id"], nulls_last("name"))) == [(1, "A"), (2, None)]
    # A hot key leaves each map task as one row.
    plan = distinct_on(names, ["wb_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_merge(spark):
    stored = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    staged = spark.createDataFrame([(2, "new"), (3, "new"), (3, "other")], "k int, v string")
    merged = merge_by_key(stored, staged, ["k"])
    assert rows(merged) == [(1, "old"), (2, "new"), (3, "new")]
    assert rows(merge_by_key(merged, staged, ["k"])) == rows(merged)


def test_pending(spark):
    work = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(pending(work, work.where("k = 1"), ["k"])) == [(2,)]


def test_resolve(spark):
    dictionaries = {
        "brands": spark.createDataFrame([(1,)], "wb_id int"),
        "sellers": spark.createDataFrame([(9,)], "wb_id int"),
    }
    staged = spark.createDataFrame(
        [(at(1), 1, "a", "u", 1, 9), (at(1), 2, "b", "u", 1, None), (at(1), 3, "c", "u", 1, 8), (at(1), 4, "d", "u", 2, 9),
         (at(1), 5, None, "u", 1, 9)], TABLES["products"].staging)
    kept, rejects, observed = resolve(staged, TABLES["products"], dictionaries)
    assert rows(kept, "sku", "seller_wb_id") == [(1, 9), (2, None), (3, None)]
    assert observed.get == {"rejected": 2}
    assert rows(rejects, "sku", "reason") == [(4, "unknown in brands"), (5, "null name")]


def test_sku_batches(spark):
    rng = random.Random(3)
    skus = rng.sample(range(-5, 3_000_000), 1000) + [2**31 - 1, -(2**31)]
    frame = spark.createDataFrame([(s,) for s in skus + skus[:50]], "sku int")
    found = [r.skus for r in sku_batches(frame).orderBy("batch").collect()]
    ordered = sorted(set(skus))
    assert found == [ordered[i:i + 300] for i in range(0, len(ordered), 300)]


def test_staging_text(spark, tmp_path):
    spec = TABLES["sellers"]
    staged = spark.createDataFrame(
        [(at(1, 3), 1, 'a\tb"\n', "\\N", None, "\\", "", "x\\ty")], spec.staging)
    line = to_lines(staged, spec).first()[0]
    assert line == '2024-03-01 03:00:00.0\t1\tab"\t\\\\N\t\\N\t\\\\\t\tx\\\\ty'
    back = from_lines(to_lines(staged, spec), spec).first()
    assert tuple(back)[1:] == (1, 'ab"', "\\N", None, "\\", "", "x\\ty")
    path = str(tmp_path / "catalogs")
    catalogs = spark.createDataFrame([(at(1), "s", "q"), (at(1), "s", "q"), (at(1), "s", "")], TABLES["catalogs"].staging)
    write_staging_text(catalogs, TABLES["catalogs"], path)
    write_staging_text(catalogs, TABLES["catalogs"], path)
    assert read_staging_text(spark, TABLES["catalogs"], path).count() == 6
    assert rows(stored_catalogs(spark, TABLES["catalogs"], path)) == [("s", ""), ("s", "q")]
