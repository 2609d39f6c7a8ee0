"""Parsed replies of a snapshot, kept until its day is settled, so that a later run parses new replies only.

A unit is one reply. Every run that parses writes its rows and the keys of the replies it took, then a marker; rows
and keys without a marker are those of a lost run and don't count.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.dedupe import pending
from shelfwatch.sources.warehouse import Warehouse, part_of, time_of


def unit_key() -> Column:
    """A reply: its request, code and place in the order of arrival."""
    request = ["endpoint", "source_kind", "source_text", "shard", "query", "page", "sku", "code", "ingest_seq"]
    return F.xxhash64(*request).alias("unit")


class ParsedReplies:
    def __init__(self, warehouse: Warehouse, ts: datetime):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        day, point = part_of(ts).split("/")
        self.root = f"{warehouse.root}/_parsed/day={day}/point={point}"

    def _runs(self, kind: str) -> list[str]:
        names = self.warehouse.files.names(f"{self.root}/{kind}")
        return [n.removesuffix(".done") for n in names if n.endswith(".done")]

    def take(self, kind: str, replies: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Parse the replies that no finished run has parsed; returns the parsed rows of all runs."""
        folder = f"{self.root}/{kind}"
        runs = self._runs(kind)
        run = uuid.uuid4().hex
        units = f"{folder}/{run}/units"
        if not runs:
            rows = parse(replies)
            replies.select(unit_key()).write.parquet(units)
            fresh = True
        else:
            done = self.spark.read.schema("unit bigint").parquet(*[f"{folder}/{r}/units" for r in runs])
            # Replies are only added to a landing: as many units as replies are all of them. Footers and codes tell.
            fresh = replies.count() != done.count()
            todo = replies.limit(0)
            if fresh:
                # The keys alone are compared; bodies are read once, of the replies that are left.
                pending(replies.select(unit_key()), done, ["unit"]).write.parquet(units)
                left = self.spark.read.schema("unit bigint").parquet(units)
                fresh = not left.isEmpty()
                todo = replies.withColumn("unit", unit_key()).join(left, "unit", "left_semi").drop("unit") if fresh else todo
            rows = parse(todo)
        if fresh:
            rows.write.parquet(f"{folder}/{run}/rows")
            self.warehouse.files.create(f"{folder}/{run}.done", "")
            runs.append(run)
        return self.spark.read.schema(rows.schema).parquet(*[f"{folder}/{r}/rows" for r in runs])


def forget_parsed(warehouse: Warehouse, before: datetime) -> None:
    """Delete what is kept for snapshots before a time."""
    root = f"{warehouse.root}/_parsed"
    for day in warehouse.files.names(root):
        points = warehouse.files.names(f"{root}/{day}")
        old = [p for p in points if time_of(f"{day.removeprefix('day=')}/{p.removeprefix('point=')}") < before]
        if len(old) == len(points):
            warehouse.files.delete(f"{root}/{day}")
        else:
            for point in old:
                warehouse.files.delete(f"{root}/{day}/{point}")
