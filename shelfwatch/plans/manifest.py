"""Progress markers of the snapshot jobs, a small append-only table by day."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.calendar import grid_point, midnight, utc
from shelfwatch.session import empty_frame, literal_row
from shelfwatch.sources.warehouse import Warehouse

MARKERS = T.StructType(
    [
        T.StructField("snapshot_ts", T.TimestampType()),
        T.StructField("unit", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)
TIME = "yyyy-MM-dd HH:mm:ss"
_NAME = "%Y%m%dT%H%M%S"


class Manifest:
    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.root = f"{warehouse.root}/_manifest"

    def _folder(self, ts: datetime) -> str:
        return f"{self.root}/day={utc(ts):%Y%m%d}"

    def markers(self, ts: datetime) -> DataFrame:
        """Markers of the day of ``ts``: a new day starts without any."""
        folder = self._folder(ts)
        if not any(n.startswith("part-") for n in self.warehouse.files.names(folder)):
            return empty_frame(self.spark, MARKERS)
        return self.spark.read.schema(MARKERS).json(folder)

    def mark(self, ts: datetime, unit: str, *keys: str) -> None:
        """Append one marker per key."""
        row = literal_row(self.spark, MARKERS, {"snapshot_ts": utc(ts), "unit": unit, "key": None})
        marked = row.withColumn("key", F.explode(F.array(*map(F.lit, keys))))
        marked.write.mode("append").json(self._folder(ts))

    def count(self, ts: datetime, replies: int) -> None:
        """Remember how many replies a run of the snapshot sees. File names hold it, so that a listing tells all."""
        name = f"{utc(ts):{_NAME}}.{replies}"
        if name not in self.warehouse.files.names(f"{self.root}/replies"):
            self.warehouse.files.create(f"{self.root}/replies/{name}", "")

    def counts(self) -> dict[datetime, int]:
        """Replies that the last run of each snapshot saw, oldest snapshot first."""
        found: dict[datetime, int] = {}
        for name in self.warehouse.files.names(f"{self.root}/replies"):
            ts, n = name.split(".")
            when = datetime.strptime(ts, _NAME).replace(tzinfo=timezone.utc)
            found[when] = max(int(n), found.get(when, 0))
        return dict(sorted(found.items()))

    def forget(self, before: datetime) -> None:
        """Delete the markers of the days before a time."""
        for folder, label in ((self.root, f"day={utc(before):%Y%m%d}"), (f"{self.root}/replies", f"{utc(before):{_NAME}}")):
            for name in self.warehouse.files.names(folder):
                if name[0] == label[0] and name < label:
                    self.warehouse.files.delete(f"{folder}/{name}")

    @staticmethod
    def _collected(markers: DataFrame) -> set[tuple[datetime, str, str]]:
        rows = markers.select(F.date_format("snapshot_ts", TIME).alias("ts"), "unit", "key").collect()
        return {(utc(datetime.fromisoformat(r.ts)), r.unit, r.key) for r in rows}

    def _units(self, day: datetime) -> set[tuple[datetime, str, str]]:
        """Job-level markers of a day; a run has a few dozen, whatever the size of the data."""
        return self._collected(self.markers(day))

    def done(self, ts: datetime) -> set[tuple[str, str]]:
        return {(unit, key) for when, unit, key in self._units(ts) if when == utc(ts)}

    def full_done(self, ts: datetime) -> bool:
        """True once the day of ``ts`` has a finished full run."""
        return any(unit == "finish" and key == "full" for _, unit, key in self._units(ts))

    def choose(self, now: datetime) -> tuple[datetime, str] | None:
        """Snapshot time and kind of the run to do at ``now``; None if its grid point is done.

        An unfinished run of the day keeps its time. The first run of a day is the full one.
        """
        units = self._units(midnight(now))
        finished = {when for when, unit, _ in units if unit == "finish"}
        begun = sorted(when for when, unit, _ in units if unit == "begin" and when not in finished)
        ts = begun[0] if begun else grid_point(now)
        if ts in finished:
            return None
        full_done = any(unit == "finish" and key == "full" for _, unit, key in units)
        return ts, "point" if full_done else "full"
