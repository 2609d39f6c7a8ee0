"""Parquet tables with immutable revisions and one pointer file per table.

Layout of a table folder::

    data/rev=<n>/...                              dictionary, one part per revision
    data/rev=<n>/day=yyyyMMdd/point=HHmmss/...    history, one folder per snapshot
    pointer/<n>.json                              live revision of every part, highest n counts

A writer puts a new revision beside the old ones and switches the pointer last, so readers see the table before
or after a load and a lost driver leaves it as it was. There is one writer per warehouse at a time; a second
one fails at the pointer instead of overwriting it. History parts are snapshots: a new snapshot is written
without reading older ones, and choosing snapshots, dropping or compacting them are pointer changes.

A dictionary has three kinds of parts: ``all``, the table that readers see; for each snapshot that may still be run
again, the rows it contributed; and ``base``, what snapshots before those left. ``all`` is always the newest row of each key
among the others, so late or repeated snapshots neither set newer rows back nor leave rows that they withdrew.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions.calendar import utc
from shelfwatch.operators.dedupe import distinct_on, merge_by_key, newest_by_key, nulls_last
from shelfwatch.operators.retention import keep_seen_since
from shelfwatch.session import empty_frame
from shelfwatch.tables import TABLES, TableSpec

_PART_FORMAT = "%Y%m%d/%H%M%S"
_WHOLE, _BASE = "all", "base"


def part_of(ts: datetime) -> str:
    return utc(ts).strftime(_PART_FORMAT)


def time_of(part: str) -> datetime:
    return datetime.strptime(part, _PART_FORMAT).replace(tzinfo=timezone.utc)


class Files:
    """The few file operations DataFrame writers lack, on whatever file system the path names."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        path = self._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self._conf), path

    def names(self, folder: str) -> list[str]:
        fs, path = self._open(folder)
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def read(self, file: str) -> str:
        fs, path = self._open(file)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> None:
        """Write a new file; fails if it exists, also where a rename would overwrite."""
        fs, target = self._open(file)
        try:
            stream = fs.create(target, False)
        except Py4JJavaError as error:
            raise RuntimeError(f"{file} was written by another job") from error
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def changed(self, file: str) -> float:
        """Seconds since the epoch of the last change."""
        fs, path = self._open(file)
        return fs.getFileStatus(path).getModificationTime() / 1000

    def delete(self, folder: str) -> None:
        fs, path = self._open(folder)
        fs.delete(path, True)

    def move(self, file: str, target: str) -> None:
        """Rename a file, making the folders it goes to."""
        fs, source = self._open(file)
        _, target = self._open(target)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise RuntimeError(f"{file} can't be moved")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)

    # --- pointers -----------------------------------------------------------------------------------------

    def _pointers(self, table: str) -> list[int]:
        names = self.files.names(f"{self.root}/{table}/pointer")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _pointer(self, table: str) -> tuple[int, dict[str, int]]:
        numbers = self._pointers(table)
        if not numbers:
            return 0, {}
        text = self.files.read(f"{self.root}/{table}/pointer/{max(numbers):010d}.json")
        return max(numbers), json.loads(text)

    def _switch(self, table: str, number: int, parts: dict[str, int]) -> None:
        self.files.create(f"{self.root}/{table}/pointer/{number:010d}.json", json.dumps(parts, sort_keys=True))

    def _data(self, table: str) -> str:
        return f"{self.root}/{table}/data"

    def _next_revision(self, table: str) -> int:
        used = [int(n.removeprefix("rev=")) for n in self.files.names(self._data(table)) if n.startswith("rev=")]
        return max([0, *used]) + 1

    # --- reading ------------------------------------------------------------------------------------------

    def snapshot_times(self, table: str) -> list[datetime]:
        """Snapshot times with rows in a history table, or that a dictionary keeps apart, from the pointer alone."""
        return sorted(time_of(part) for part in self._pointer(table)[1] if part not in (_WHOLE, _BASE))

    def read(self, table: str, keep: Callable[[datetime], bool] | None = None) -> DataFrame:
        """Live rows; ``keep`` chooses snapshots of a history table before any file is listed."""
        spec = TABLES[table]
        _, parts = self._pointer(table)
        if not spec.is_history:
            parts = {part: rev for part, rev in parts.items() if part == _WHOLE}
        elif keep is not None:
            parts = {part: rev for part, rev in parts.items() if keep(time_of(part))}
        return self._scan(spec, parts)

    def at(self, table: str, *times: datetime) -> DataFrame:
        wanted = set(map(utc, times))
        return self.read(table, lambda ts: ts in wanted)

    def as_of(self, table: str, ts: datetime) -> DataFrame:
        """A dictionary as the snapshot of a time met it: without what later snapshots contributed."""
        spec = TABLES[table]
        _, parts = self._pointer(table)
        last = part_of(ts)
        apart = {p: rev for p, rev in parts.items() if p not in (_WHOLE, _BASE)}
        if all(p <= last for p in apart):
            return self.read(table)
        known = {p: rev for p, rev in parts.items() if p == _BASE or p in apart and p <= last}
        rows = self._scan(spec, known)
        # One part alone has one row per key already.
        return self._newest(spec, rows) if len(known) > 1 else rows

    def _scan(self, spec: TableSpec, parts: dict[str, int]) -> DataFrame:
        if not parts:
            return empty_frame(self.spark, spec.final)
        data = self._data(spec.name)
        paths = []
        for part, rev in sorted(parts.items()):
            if not spec.is_history:
                paths.append(f"{data}/rev={rev}")
            else:
                day, point = part.split("/")
                paths.append(f"{data}/rev={rev}/day={day}/point={point}")
        return self.spark.read.schema(spec.final).option("basePath", data).parquet(*paths).select(
            *spec.final.names
        )

    # --- writing ------------------------------------------------------------------------------------------

    def _order(self, spec: TableSpec):
        return nulls_last(*spec.nulls_last_order)

    def _newest(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        return newest_by_key(rows, spec.key, "last_timestamp", self._order(spec))

    def _stored(self, spec: TableSpec, rows: DataFrame) -> int:
        """Write a part of a dictionary and return its revision."""
        rev = self._next_revision(spec.name)
        rows.select(*spec.final.names).write.parquet(f"{self._data(spec.name)}/rev={rev}")
        return rev

    def upsert_dictionary(self, table: str, staged: DataFrame) -> None:
        """Insert new keys and refresh all other columns of known ones, unless they come from a newer snapshot.

        The rows belong to no snapshot that can be run again.
        """
        spec = TABLES[table]
        number, parts = self._pointer(table)
        fresh = staged.withColumnRenamed("timestamp", "last_timestamp").select(*spec.final.names).withColumn("_stored", F.lit(0))
        apart = set(parts) - {_WHOLE, _BASE}

        def merged(part: str) -> int:
            known = self._scan(spec, {part: parts[part]} if part in parts else {}).withColumn("_stored", F.lit(1))
            rows = newest_by_key(fresh.unionByName(known), spec.key, "last_timestamp", ["_stored", *self._order(spec)])
            return self._stored(spec, rows)

        base = merged(_BASE if apart or _BASE in parts else _WHOLE)
        self._switch(table, number + 1, {**parts, _BASE: base, _WHOLE: merged(_WHOLE) if apart else base})

    def put_snapshot(self, table: str, staged: DataFrame, ts: datetime, unique: bool = False) -> bool:
        """Make the rows what the snapshot contributes to a dictionary; ``unique`` says that they have one row per key.

        A new snapshot is merged into the table. One that is there already has the table made again from the base and
        the snapshots kept apart. True if later snapshots may have met other keys than there are now.
        """
        spec = TABLES[table]
        number, parts = self._pointer(table)
        part = part_of(ts)
        fresh = staged.withColumnRenamed("timestamp", "last_timestamp").select(*spec.final.names)
        apart = {p: rev for p, rev in parts.items() if p not in (_WHOLE, _BASE)}
        before = self._keys(spec, apart[part]) if part in apart else None
        rev = self._stored(spec, fresh if unique else self._newest(spec, fresh))
        whole_rev = rev
        if part in apart:
            base = {_BASE: parts[_BASE]} if _BASE in parts else {}
            whole_rev = self._stored(spec, self._newest(spec, self._scan(spec, {**base, **apart, part: rev})))
        elif _WHOLE in parts:
            whole_rev = self._stored(spec, self._newest(spec, self._scan(spec, {_WHOLE: parts[_WHOLE], part: rev})))
        self._switch(table, number + 1, {**parts, part: rev, _WHOLE: whole_rev})
        if not apart or part >= max(apart):
            return False
        return (before or (0, None)) != self._keys(spec, rev)

    def _keys(self, spec: TableSpec, rev: int) -> tuple:
        """Number and combined hash of a part's keys, which are distinct."""
        keys = self._scan(spec, {_BASE: rev}).agg(F.count("*"), F.bit_xor(F.xxhash64(*spec.key)))
        return tuple(keys.first())

    def settle_dictionary(self, table: str, before: datetime) -> None:
        """Fold the snapshots before a time into the base: they can't be run again."""
        spec = TABLES[table]
        number, parts = self._pointer(table)
        old = {p: rev for p, rev in parts.items() if p not in (_WHOLE, _BASE) and time_of(p) < before}
        if not old:
            return
        kept = {p: rev for p, rev in parts.items() if p not in old}
        if not set(kept) - {_WHOLE, _BASE}:
            # Nothing is newer, so the table itself is the base.
            self._switch(table, number + 1, {**kept, _BASE: parts[_WHOLE]})
            return
        sources = {**old, **({_BASE: parts[_BASE]} if _BASE in parts else {})}
        base = self._stored(spec, self._newest(spec, self._scan(spec, sources)))
        self._switch(table, number + 1, {**kept, _BASE: base})

    def trim_dictionary(self, table: str, edge: datetime) -> None:
        """Drop rows last seen before a time."""
        spec = TABLES[table]
        number, parts = self._pointer(table)
        if self.read(table).where(F.col("last_timestamp") < F.lit(edge)).isEmpty():
            return
        kept = {p: rev for p, rev in parts.items() if p in (_WHOLE, _BASE) or time_of(p) >= edge}
        for part in (_WHOLE, _BASE):
            if part in kept:
                kept[part] = self._stored(spec, keep_seen_since(self._scan(spec, {part: kept[part]}), F.lit(edge)))
        self._switch(table, number + 1, kept)

    def upsert_history(
        self, table: str, staged: DataFrame, times: Iterable[datetime], unique: bool = False
    ) -> None:
        """Upsert rows of the given snapshots; only snapshots that are already stored are read back.

        ``unique`` says that the staged rows have one row per key, which spares a new snapshot the shuffle.
        """
        times = list(times)
        spec = TABLES[table]
        _, parts = self._pointer(table)
        stored = {part_of(t): parts[part_of(t)] for t in times if part_of(t) in parts}
        fresh = staged.select(*spec.final.names)
        if stored:
            rows = merge_by_key(self._scan(spec, stored), fresh, spec.key)
        else:
            rows = fresh if unique else distinct_on(fresh, spec.key)
        self._write_history(spec, rows, set(map(part_of, times)), dropped=())

    def replace_history(self, table: str, rows: DataFrame, times: Iterable[datetime]) -> None:
        """Make ``rows`` the whole content of the given snapshots, which may become empty."""
        parts = set(map(part_of, times))
        self._write_history(TABLES[table], rows.select(*TABLES[table].final.names), parts, dropped=parts)

    def _write_history(
        self, spec: TableSpec, rows: DataFrame, expected: set[str], dropped: Iterable[str]
    ) -> None:
        number, parts = self._pointer(spec.name)
        rev = self._next_revision(spec.name)
        target = f"{self._data(spec.name)}/rev={rev}"
        labelled = rows.withColumns(
            {"day": F.date_format("timestamp", "yyyyMMdd"), "point": F.date_format("timestamp", "HHmmss")}
        )
        if len(expected) > 1:
            # Files per snapshot by size, not one per task and snapshot; large snapshots are split at run time.
            labelled = labelled.hint("rebalance", "day", "point")
        labelled.write.partitionBy("day", "point").parquet(target)
        written = {
            f"{day.removeprefix('day=')}/{point.removeprefix('point=')}"
            for day in self.files.names(target) if day.startswith("day=")
            for point in self.files.names(f"{target}/{day}") if point.startswith("point=")
        }
        if not written <= expected:
            raise ValueError(f"{spec.name}: rows for unexpected snapshots {sorted(written - expected)}")
        kept = {part: r for part, r in parts.items() if part not in set(dropped)}
        self._switch(spec.name, number + 1, {**kept, **{part: rev for part in written}})

    def drop_history(self, table: str, unwanted: Callable[[datetime], bool]) -> None:
        """Drop snapshots; their files go with the next ``vacuum``."""
        number, parts = self._pointer(table)
        kept = {part: rev for part, rev in parts.items() if not unwanted(time_of(part))}
        if kept != parts:
            self._switch(table, number + 1, kept)

    def vacuum(self, keep_hours: float = 48) -> None:
        """Delete files that only pointers replaced more than ``keep_hours`` ago name.

        A frame stays readable for so long after the table changed. Not part of a run; no run may go on beside it.
        """
        edge = time.time() - 3600 * keep_hours
        for table in TABLES:
            numbers = sorted(self._pointers(table))
            # A pointer was replaced when the next one was made.
            made = {n: self.files.changed(f"{self.root}/{table}/pointer/{n:010d}.json") for n in numbers}
            old = [n for n, following in zip(numbers, numbers[1:]) if made[following] < edge]
            for number in old:
                self.files.delete(f"{self.root}/{table}/pointer/{number:010d}.json")
            live: set[tuple[int, str]] = set()
            for number in numbers[len(old):]:
                parts = json.loads(self.files.read(f"{self.root}/{table}/pointer/{number:010d}.json"))
                live |= {(rev, part) for part, rev in parts.items()}
            live_revisions = {rev for rev, _ in live}
            data = self._data(table)
            for name in self.files.names(data):
                if not name.startswith("rev="):
                    continue
                rev = int(name.removeprefix("rev="))
                if rev not in live_revisions:
                    self.files.delete(f"{data}/{name}")
                elif TABLES[table].is_history:
                    self._vacuum_parts(f"{data}/{name}", {part for r, part in live if r == rev})

    def _vacuum_parts(self, folder: str, live: set[str]) -> None:
        for day in self.files.names(folder):
            if not day.startswith("day="):
                continue
            points = [p for p in self.files.names(f"{folder}/{day}") if p.startswith("point=")]
            dead = [p for p in points if f"{day.removeprefix('day=')}/{p.removeprefix('point=')}" not in live]
            if len(dead) == len(points):
                self.files.delete(f"{folder}/{day}")
            else:
                for point in dead:
                    self.files.delete(f"{folder}/{day}/{point}")
