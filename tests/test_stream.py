import pytest
from conftest import at, rows
from landing_fixture import Replies, full_replies, page_body, product, stocks_body
from pyspark.sql import functions as F

from shelfwatch.plans.jobs import run_full, run_point
from shelfwatch.plans.parsed import ParsedReplies
from shelfwatch.sources.landing import append_landing, read_landing, stream_landing
from shelfwatch.sources.warehouse import Warehouse
from shelfwatch.streaming.snapshots import apply_stock_batch, stream_replies, stream_snapshots
from shelfwatch.tables import TABLES


def shown(warehouse, table):
    return rows(
        warehouse.read(table).select(
            F.date_format("timestamp", "ddHH"), F.date_format("timestamp_to", "ddHH"), "product_sku", "quantity"
        )
    )


def stock(spark, *entries):
    return spark.createDataFrame([(t, k, "M", 1, q) for t, k, q in entries], TABLES["stocks"].staging)


def test_late_snapshot_splits_its_pair(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    apply_stock_batch(warehouse, stock(spark, (at(1), 1, 10), (at(1, 9), 1, 4)))
    assert shown(warehouse, "orders") == [("0100", "0109", 1, 6)]
    apply_stock_batch(warehouse, stock(spark, (at(1, 3), 1, 12)))
    assert shown(warehouse, "orders") == [("0103", "0109", 1, 8)]
    assert shown(warehouse, "refills") == [("0100", "0103", 1, 2)]
    # The same snapshot again overwrites; nothing changed, so nothing does.
    apply_stock_batch(warehouse, stock(spark, (at(1, 3), 1, 12)))
    assert shown(warehouse, "orders") == [("0103", "0109", 1, 8)]
    apply_stock_batch(warehouse, stock(spark, (at(1, 3), 1, 10)))
    assert shown(warehouse, "orders") == [("0103", "0109", 1, 6)]
    assert shown(warehouse, "refills") == []


def test_stream_equals_batch(spark, tmp_path):
    levels = [(101, "M", {1: 10, 2: 4}), (102, "L", {1: 6})]
    replies = [full_replies(at(1), levels), Replies(at(1, 3)).add("stocks", stocks_body((101, "M", {1: 3, 2: 5})))]
    batch, streamed = Warehouse(spark, str(tmp_path / "batch")), Warehouse(spark, str(tmp_path / "stream"))
    frames = [r.frame(spark) for r in replies]
    for run, frame, ts in zip((run_full, run_point), frames, (at(1), at(1, 3))):
        run(batch, frame, ts)

    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    landing = None
    for frame in frames:
        append_landing(frame, path)
        landing = stream_landing(spark, path)
        stream_replies(streamed, landing, read_landing(spark, path), checkpoint).awaitTermination()
    for table in TABLES:
        assert rows(streamed.read(table)) == rows(batch.read(table)), table
    assert shown(streamed, "orders") == [("0100", "0103", 101, 7)]
    assert shown(streamed, "refills") == [("0100", "0103", 101, 1)]
    # Nothing new: another drain leaves the pointers alone.
    before = {t: streamed._pointer(t) for t in TABLES}
    stream_replies(streamed, landing, read_landing(spark, path), checkpoint).awaitTermination()
    assert {t: streamed._pointer(t) for t in TABLES} == before


def test_snapshot_times_off_the_grid_are_refused(spark, tmp_path):
    from shelfwatch.streaming import snapshots

    hours = spark.range(20_000).select(F.timestamp_seconds(F.col("id") * 3 * 3600).alias("timestamp"))
    assert len(snapshots.batch_times(hours, "timestamp")) == 20_000
    stray = hours.union(spark.range(1).select(F.timestamp_seconds(F.lit(7201))))
    with pytest.raises(ValueError, match="grid"):
        snapshots.batch_times(stray, "timestamp")


def test_split_snapshot_in_any_order_equals_batch(spark, tmp_path):
    frame = full_replies(at(1), [(101, "M", {1: 10, 2: 4}), (102, "L", {1: 6})]).frame(spark)
    batch, streamed = Warehouse(spark, str(tmp_path / "batch")), Warehouse(spark, str(tmp_path / "stream"))
    run_full(batch, frame, at(1))
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    late = F.col("endpoint").isin("seller", "catalog")
    for part in (frame.where(~late), frame.where(late)):
        append_landing(part, path)
        stream_replies(streamed, stream_landing(spark, path), read_landing(spark, path), checkpoint).awaitTermination()
    for table in TABLES:
        assert rows(streamed.read(table)) == rows(batch.read(table)), table


def drained(warehouse, path, checkpoint, *frames):
    for frame in frames:
        append_landing(frame, path)
    spark = warehouse.spark
    stream_snapshots(warehouse, stream_landing(spark, path, maxFilesPerTrigger=6), read_landing(spark, path), checkpoint).awaitTermination()


def closing(spark, ts):
    """A refused reply of a snapshot, which completes those before it."""
    return Replies(ts).add("page", "", code=500).frame(spark)


def test_snapshot_in_many_files_runs_once(spark, tmp_path, monkeypatch):
    from shelfwatch.streaming import snapshots

    runs = []
    for name in ("run_full", "run_point"):
        run = getattr(snapshots, name)
        monkeypatch.setattr(snapshots, name, lambda w, f, ts, *a, run=run: (runs.append(ts), run(w, f, ts, *a)))
    frame = full_replies(at(1), [(101, "M", {1: 10, 2: 4}), (102, "L", {1: 6})]).frame(spark)
    point = Replies(at(1, 3)).add("stocks", stocks_body((101, "M", {1: 3, 2: 5}))).frame(spark)
    batch, streamed = Warehouse(spark, str(tmp_path / "batch")), Warehouse(spark, str(tmp_path / "stream"))
    run_full(batch, frame, at(1))
    run_point(batch, point, at(1, 3))
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    drained(streamed, path, checkpoint, *[frame.where(F.col("ingest_seq") % 4 == k) for k in range(4)])
    assert runs == []  # the snapshot is still open
    drained(streamed, path, checkpoint, point, closing(spark, at(1, 6)))
    assert runs == [at(1), at(1, 3)]
    for table in TABLES:
        assert rows(streamed.read(table)) == rows(batch.read(table)), table


def test_late_replies_neither_set_back_nor_leave_rows(spark, tmp_path, monkeypatch):
    """After two days: the first day's empty page, behind which a page was read, and one more seller."""
    first = full_replies(at(1), [(101, "M", {1: 10})])
    first.rows = [r for r in first.rows if not (r[0] == "page" and r[5] == 2)]
    first.add("page", page_body(product(555, brand=7)), shard="home1", query="cat=1", page=3)
    late = Replies(at(1))
    late.rows = [None] * 100
    late.add("page", page_body(), shard="home1", query="cat=1", page=2)
    late.add("seller", '{"supplierId": 8, "supplierName": "L"}', sku=102)
    late.rows = late.rows[100:]
    second = full_replies(at(2), [(101, "M", {1: 7}), (555, "S", {1: 1})])
    second.rows = [r for r in second.rows if r[0] != "page"]
    second.add("page", page_body(product(101, name="newest")), shard="home1", query="cat=1", page=1)
    frames = [r.frame(spark) for r in (first, second, late)]
    batch, streamed = Warehouse(spark, str(tmp_path / "batch")), Warehouse(spark, str(tmp_path / "stream"))
    run_full(batch, frames[0].unionByName(frames[2]), at(1))
    run_full(batch, frames[1], at(2))
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    drained(streamed, path, checkpoint, frames[0], frames[1], closing(spark, at(2, 3)))
    assert (555,) in rows(streamed.read("products"), "sku")

    parsed = []
    take = ParsedReplies.take

    def counting(self, kind, replies, parse):
        return take(self, kind, replies, lambda todo: (parsed.append((self.root[-25:], kind, todo.count())), parse(todo))[1])

    monkeypatch.setattr(ParsedReplies, "take", counting)
    drained(streamed, path, checkpoint, frames[2])
    # Only the two late replies are parsed, also where the second day is loaded again.
    assert sorted((kind, n) for _, kind, n in parsed if n) == [("page", 1), ("seller", 1)]
    for table in TABLES:
        assert rows(streamed.read(table)) == rows(batch.read(table)), table
    assert (101, "newest") in rows(streamed.read("products"), "sku", "name")
    assert (555,) not in rows(streamed.read("products"), "sku")
