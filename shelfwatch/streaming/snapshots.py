"""The snapshot chain as a stream: file source, one micro-batch per trigger, idempotent ``foreachBatch``.

The checkpoint replays a failed batch, and every load is an upsert by key and snapshot, so a replay changes
nothing. ``stream_snapshots`` runs a snapshot once, when the watermark has passed its three hours; what arrives later is
found by count, parsed alone and taken in as if it had come in time. ``stream_replies`` runs a snapshot whenever it gets
replies, for callers that can't wait.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwatch.functions.calendar import GRID_HOURS, point_floor, utc
from shelfwatch.plans.jobs import catch_up, rederive_changes, run_again, run_full, run_point
from shelfwatch.plans.manifest import Manifest
from shelfwatch.sources.warehouse import Warehouse


def batch_times(batch: DataFrame, column: str) -> list[datetime]:
    """Snapshot times of a batch, eight a day at most; a time off the grid is refused."""
    text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    on_grid = F.coalesce(F.col(column) == point_floor(F.col(column)), F.lit(False))
    # One pass: times off the grid, of which there may be any number, fall into one group.
    found = batch.select(F.when(on_grid, text).alias("ts"), F.when(~on_grid, F.coalesce(text, F.lit("null"))).alias("stray"))
    rows = found.groupBy("ts").agg(F.min("stray").alias("stray")).collect()
    for r in rows:
        if r.ts is None:
            raise ValueError(f"{column} {r.stray} is not on the snapshot grid")
    return sorted(utc(datetime.fromisoformat(r.ts)) for r in rows)


def apply_stock_batch(warehouse: Warehouse, stocks: DataFrame) -> None:
    """Merge stock rows of any number of snapshots and derive all pairs they touch, in one pass each."""
    times = batch_times(stocks, "timestamp")
    if times:
        warehouse.upsert_history("stocks", stocks, times)
        rederive_changes(warehouse, times)


def apply_landing_batch(
    warehouse: Warehouse, batch: DataFrame, landing: DataFrame, warehouse_file: str | None = None, strict: bool = False
) -> None:
    """Run the job of each snapshot that the batch touches, oldest first, on all its replies in ``landing``."""
    manifest = Manifest(warehouse)
    for ts in batch_times(batch, "snapshot_ts"):
        stored = warehouse.snapshot_times("stocks")
        finished = any(unit == "finish" for unit, _ in manifest.done(ts))
        if not finished and (not stored or ts >= stored[-1]):
            full = not manifest.full_done(ts)
            (run_full if full else run_point)(warehouse, landing, ts, warehouse_file, strict)
        else:
            run_again(warehouse, landing, ts, warehouse_file, strict)


def run_complete(
    warehouse: Warehouse, complete: DataFrame, landing: DataFrame, warehouse_file: str | None = None, strict: bool = False
) -> None:
    """Run each snapshot that is complete, oldest first, then those that got replies after their run."""
    manifest = Manifest(warehouse)
    for ts in batch_times(complete, "snapshot_ts"):
        if any(unit == "finish" for unit, _ in manifest.done(ts)):
            continue
        stored = warehouse.snapshot_times("stocks")
        if stored and ts < stored[-1]:
            run_again(warehouse, landing, ts, warehouse_file, strict)
        else:
            (run_point if manifest.full_done(ts) else run_full)(warehouse, landing, ts, warehouse_file, strict)
    catch_up(warehouse, landing, warehouse_file, strict)


def _available_now(stream: DataFrame, checkpoint: str, apply, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )


def stream_stocks(warehouse: Warehouse, stocks: DataFrame, checkpoint: str, prepare=None) -> StreamingQuery:
    """Drain stock rows into the warehouse; ``prepare`` turns a raw micro-batch into stock rows."""

    def apply(batch: DataFrame, _: int) -> None:
        # The batch is read for its times and for the load.
        rows = (prepare(batch) if prepare else batch).persist()
        try:
            apply_stock_batch(warehouse, rows)
        finally:
            rows.unpersist()

    return _available_now(stocks, checkpoint, apply)


def stream_replies(
    warehouse: Warehouse, arrivals: DataFrame, landing: DataFrame, checkpoint: str, warehouse_file: str | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Drain ``arrivals``, the stream of the folder that ``landing`` reads, into the warehouse.

    The stream only names the snapshots that got replies; a snapshot's job takes all its replies from ``landing``, parses
    those it hasn't parsed, and replaces what it loaded before, so the order of arrival makes no difference to the tables.
    """

    def apply(batch: DataFrame, _: int) -> None:
        apply_landing_batch(warehouse, batch, landing, warehouse_file, strict)

    return _available_now(arrivals, checkpoint, apply)


def stream_snapshots(
    warehouse: Warehouse, arrivals: DataFrame, landing: DataFrame, checkpoint: str, delay: str = "0 hours",
    warehouse_file: str | None = None, strict: bool = False,
) -> StreamingQuery:
    """Drain ``arrivals``, the stream of the folder that ``landing`` reads, running each snapshot once it is complete.

    A snapshot is a tumbling window of three hours. It is complete when the watermark, which is the newest snapshot seen
    less ``delay``, reaches its end; until then its replies may come in any number of files and batches. The newest one
    stays open: the next snapshot closes it. The state of the stream is one count per open window.
    """
    complete = (
        arrivals.select("snapshot_ts").withWatermark("snapshot_ts", delay)
        .groupBy(F.window("snapshot_ts", f"{GRID_HOURS} hours")).agg(F.count("*").alias("replies"))
        .select(F.col("window.start").alias("snapshot_ts"))
    )

    def apply(batch: DataFrame, _: int) -> None:
        run_complete(warehouse, batch, landing, warehouse_file, strict)

    return _available_now(complete, checkpoint, apply)
