"""Snapshot jobs: landing replies of one snapshot into the warehouse, then changes and upkeep.

Each import is skipped when its marker exists, and repeats harmlessly when only the marker is missing. Parsed replies
are kept with the warehouse until their day is compacted: a run that starts again, or meets late replies, parses what it
hasn't parsed yet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import closing
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.calendar import grid_point, midnight, utc
from shelfwatch.functions.scalars import normalise_text
from shelfwatch.operators import extract as E
from shelfwatch.operators.changes import MERCH_KEY, history_changes, neighbour_pairs, snapshot_changes, split_changes
from shelfwatch.operators.compact import compact_changes, compaction_day
from shelfwatch.operators.resolve import check, resolve
from shelfwatch.operators.retention import active_products, retention_edge
from shelfwatch.plans.manifest import TIME, Manifest
from shelfwatch.plans.parsed import ParsedReplies, forget_parsed
from shelfwatch.operators.dedupe import distinct_on
from shelfwatch.session import delete_folder, empty_frame, scratch_folder
from shelfwatch.sources.landing import ACCEPTED_CODES, LANDING, read_warehouse_file, refused_replies, reject, replies
from shelfwatch.sources.staging_text import checked_lines, to_lines
from shelfwatch.sources.warehouse import Warehouse, part_of
from shelfwatch.tables import DICTIONARIES, FULL_IMPORT_WAVES, HISTORIES, POINT_IMPORT_WAVES, TABLES, TableSpec


Waves = Iterable[Iterable[str]]
# Stock replies name products of other replies, so rejects are usual: what is joined is written once for rows and rejects.
_OFTEN_REJECTED = ("sizes", "stocks")
_SOURCES = ("catalogs", "categories", "queries")
_STOCKS = ("sizes", "warehouses", "stocks")


def at_once(spark: SparkSession, steps: list[Callable[[], object]]) -> list:
    """Run independent Spark actions side by side, so one job's last tasks leave no cores idle."""
    if not steps:
        return []
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [r.result() for r in running]


class RejectedRows(RuntimeError):
    """Strict mode met a reply or row it cannot use."""


def _clean(parsed: DataFrame, *texts: str) -> DataFrame:
    """Normalise texts that are keys of a history before its one-row-per-key choice, so the load needs none."""
    return parsed.withColumns({name: normalise_text(F.col(name)) for name in texts})


class SnapshotJob:
    """One snapshot time of one warehouse."""

    def __init__(self, warehouse: Warehouse, landing: DataFrame, ts: datetime, strict: bool = False):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.ts = utc(ts)
        self.strict = strict
        self.landing = landing.where(F.col("snapshot_ts") == F.lit(self.ts))
        self.scratch = scratch_folder(self.spark, "snapshot")
        self.parsed = ParsedReplies(warehouse, self.ts)
        # Dictionaries whose keys a run of an older snapshot changed, so that later snapshots may resolve otherwise.
        self.changed_keys: set[str] = set()
        # Dictionaries that are staged with one row per key, whose texts are clean already.
        self.unique: set[str] = set()
        self.extraction_rejects: list[DataFrame] = [refused_replies(self.landing)]

    def count_replies(self, manifest: Manifest) -> None:
        """Remember how many replies the run sees, before it reads them: more of them later mean another run."""
        manifest.count(self.ts, self.landing.count())

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        """Cut the lineage: later steps read single columns of this instead of parsing again."""
        path = f"{self.scratch}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete what the job wrote to the scratch folder."""
        delete_folder(self.spark, self.scratch)

    # --- staging ------------------------------------------------------------------------------------------

    def _parse(self, endpoint: str, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return self.parsed.take(endpoint, replies(self.landing, endpoint), parse)

    def stage_sources(self) -> dict[str, DataFrame]:
        nodes = self._parse("categories", E.parse_menus)
        lists = self._parse("queries", E.parse_queries)
        answers = self._parse("catalog", E.parse_catalogs)
        bound = E.bind_sources(E.categories_of(nodes), E.queries_of(lists), E.catalogs_of(answers))
        bundle = E.category_bundle(self._written("sources", bound))
        self.extraction_rejects += [
            bundle.pop("rejects"), E.menu_rejects(nodes), E.query_list_rejects(lists), E.catalog_reply_rejects(answers),
        ]
        return bundle

    def stage_pages(self) -> dict[str, DataFrame]:
        sellers = self._parse("seller", E.parse_sellers)
        by_sku = E.sellers_by_sku(sellers)
        pages = self._parse("page", lambda pages: _clean(E.parse_pages(pages), "shard", "query"))
        bundle = E.page_bundle(pages, keep=lambda cut: self._written("cut", cut))
        self.extraction_rejects += [bundle.pop("rejects"), E.sellers_rejects(sellers)]
        self.unique |= {"brands", "sellers", "products"}
        bundle["sellers"] = E.extract_sellers(by_sku)
        bundle["products"] = E.with_seller(bundle["products"], by_sku)
        return bundle

    def stage_stocks(self, only: DataFrame | None = None, warehouse_file: str | None = None) -> dict[str, DataFrame]:
        parsed = self._parse("stocks", lambda stocks: _clean(E.parse_stocks(stocks), "size_name"))
        if only is not None:
            wanted = only.select(F.col("sku").alias("product_sku"))
            # One scan: rows with a problem stay beside those of wanted products.
            parsed = self._written(
                "stocks",
                parsed.join(wanted.distinct().withColumn("_wanted", F.lit(True)), "product_sku", "left")
                .where("problem IS NOT NULL OR _wanted").select(*parsed.columns),
            )
        self.unique.add("sizes")
        bundle = E.stock_bundle(parsed)
        self.extraction_rejects.append(bundle.pop("rejects"))
        if warehouse_file is not None:
            body = read_warehouse_file(self.spark, warehouse_file)
            self.extraction_rejects.append(E.warehouses_rejects(body))
            listed = E.extract_warehouses(body).withColumn("snapshot_ts", F.lit(self.ts))
            bundle["warehouses"] = bundle["warehouses"].unionByName(listed)
        return bundle

    def stage_all(self, warehouse_file: str | None = None) -> dict[str, DataFrame]:
        sources, pages, stocks = at_once(
            self.spark,
            [self.stage_sources, self.stage_pages, lambda: self.stage_stocks(warehouse_file=warehouse_file)],
        )
        self.keep_extraction_rejects()
        return {**sources, **pages, **stocks}

    def stage_some(self, tables: set[str], warehouse_file: str | None = None) -> dict[str, DataFrame]:
        """Frames of some tables of a full run; rejects of the extraction are left as they are."""
        stages = {
            _SOURCES: self.stage_sources, _STOCKS: lambda: self.stage_stocks(warehouse_file=warehouse_file),
            tuple(t for wave in FULL_IMPORT_WAVES for t in wave if t not in _SOURCES + _STOCKS): self.stage_pages,
        }
        staged = at_once(self.spark, [stage for names, stage in stages.items() if tables & set(names)])
        return {name: frame for frames in staged for name, frame in frames.items() if name in tables}

    def staged(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        """Staging columns, stamped with the snapshot time, texts without breaks and tabs."""
        columns = []
        for field in spec.staging.fields:
            if field.name == "timestamp":
                column = F.lit(self.ts)
            elif isinstance(field.dataType, T.StringType):
                column = normalise_text(F.col(field.name))
            else:
                column = F.col(field.name)
            columns.append(column.cast(field.dataType).alias(field.name))
        return rows.select(*columns)

    # --- loading ------------------------------------------------------------------------------------------

    def _keep_rejects(self, name: str, rejects: DataFrame) -> None:
        day, point = part_of(self.ts).split("/")
        rejects.write.mode("overwrite").parquet(f"{self.warehouse.root}/_rejects/day={day}/point={point}/{name}")

    def keep_extraction_rejects(self) -> None:
        rejects = reduce(DataFrame.unionByName, self.extraction_rejects)
        if self.strict:
            self._refuse("extraction", rejects)
        self._keep_rejects("extraction", rejects)

    def refuse_all(self, reason: str) -> None:
        """Make every reply of the snapshot a reject."""
        self.extraction_rejects = [
            reject(replies(self.landing, endpoint), endpoint, reason) for endpoint in ACCEPTED_CODES
        ]
        rejects = reduce(DataFrame.unionByName, self.extraction_rejects)
        if self.strict:
            self._refuse("late", rejects)
        self._keep_rejects("late", rejects)

    def keep_line_rejects(self, table: str, rejects: DataFrame) -> None:
        if self.strict:
            self._refuse(f"{table} file", rejects)
        self._keep_rejects(f"{table}-lines", rejects)

    def _refuse(self, stage: str, rejects: DataFrame) -> None:
        sample = rejects.limit(1).collect()
        if sample:
            raise RejectedRows(f"{stage}: {sample[0].asDict()}")

    def load(self, table: str, rows: DataFrame, replace: bool = False) -> None:
        """Upsert, or with ``replace`` make the rows the whole content of the snapshot in a history."""
        spec = TABLES[table]
        dictionaries = {
            name: self.warehouse.as_of(name, self.ts)
            for lookup in spec.lookups
            for name in (lookup.dictionary, *([lookup.parent.dictionary] if lookup.parent else []))
        }
        staged, count = self.staged(spec, rows), None
        if table in _OFTEN_REJECTED:
            checked = self._written(f"{table}-checked", check(staged, spec, dictionaries))
            kept, rejects = checked.where("reason IS NULL").drop("reason"), checked.where("reason IS NOT NULL")
        else:
            kept, rejects, count = resolve(staged, spec, dictionaries, Observation(f"{table}_rejects"))
        if self.strict:
            self._refuse(table, rejects)
        if spec.is_history and replace:
            self.warehouse.replace_history(table, kept, [self.ts])
        elif spec.is_history:
            self.warehouse.upsert_history(table, kept, [self.ts], unique=True)
        elif self.warehouse.put_snapshot(table, kept, self.ts, table in self.unique):
            self.changed_keys.add(table)
        # Other loads counted their rejects in passing; only if there are any does the join run again to list them.
        if count.get["rejected"] if count else not rejects.isEmpty():
            self._keep_rejects(table, rejects)

    def load_all(
        self, waves: Waves, frames: Mapping[str, DataFrame], manifest: Manifest | None, replace: bool = False
    ) -> None:
        done = manifest.done(self.ts) if manifest else set()
        for wave in waves:
            todo = [t for t in wave if t in frames and ("import", t) not in done]
            loaded: list[str] = []

            def load(table: str) -> None:
                self.load(table, frames[table], replace)
                loaded.append(table)

            try:
                at_once(self.spark, [lambda table=table: load(table) for table in todo])
            finally:
                if manifest and loaded:
                    manifest.mark(self.ts, "import", *loaded)

    # --- changes ------------------------------------------------------------------------------------------

    def derive_changes(self, bound: datetime) -> datetime | None:
        """Orders and refills since the newest snapshot before ``bound``; they belong to that snapshot's day."""
        previous = max((t for t in self.warehouse.snapshot_times("stocks") if t < bound), default=None)
        if previous is not None:
            changes = self._written(
                "changes",
                snapshot_changes(self.warehouse.at("stocks", previous), self.warehouse.at("stocks", self.ts)),
            )
            store_changes(self.warehouse, changes, [previous])
        return previous


def store_changes(warehouse: Warehouse, changes: DataFrame, older: list[datetime]) -> None:
    """Make the given changes the whole content of their older snapshots."""
    orders, refills = split_changes(changes)
    at_once(
        warehouse.spark,
        [
            lambda: warehouse.replace_history("orders", orders, older),
            lambda: warehouse.replace_history("refills", refills, older),
        ],
    )


def rederive_changes(warehouse: Warehouse, touched: Iterable[datetime], frozen_before: datetime | None = None) -> None:
    """Derive again every pair of neighbouring snapshots that a new or corrected snapshot takes part in.

    Pairs that start before ``frozen_before`` are left alone: compacted days hold their first snapshot only, and
    their changes are already summed.
    """
    pairs = [
        pair for pair in neighbour_pairs(warehouse.snapshot_times("stocks"), map(utc, touched))
        if frozen_before is None or pair[0] >= frozen_before
    ]
    if not pairs:
        return
    spark = warehouse.spark
    taking_part = {t for pair in pairs for t in pair}
    schema = T.StructType([T.StructField(n, T.TimestampType()) for n in ("timestamp", "timestamp_to")])
    path = scratch_folder(spark, "changes")
    try:
        derived = history_changes(warehouse.at("stocks", *taking_part), spark.createDataFrame(pairs, schema))
        derived.write.parquet(path)
        store_changes(warehouse, spark.read.schema(derived.schema).parquet(path), [a for a, _ in pairs])
    finally:
        delete_folder(spark, path)


# --- upkeep -----------------------------------------------------------------------------------------------


def compact(warehouse: Warehouse, day: datetime) -> datetime | None:
    """Compact the second last data day before ``day``; returns its start."""
    chosen = compaction_day(warehouse.snapshot_times("stocks"), utc(day))
    if chosen is None:
        return None

    def inside(ts: datetime) -> bool:
        return chosen.start <= ts < chosen.end

    warehouse.drop_history("stocks", lambda ts: inside(ts) and ts != chosen.first_snapshot)
    for table in ("orders", "refills"):
        times = [t for t in warehouse.snapshot_times(table) if inside(t)]
        if times:
            rows = warehouse.read(table, lambda ts: chosen.first_snapshot <= ts < chosen.end)
            warehouse.replace_history(table, compact_changes(rows, MERCH_KEY), times)
    settle(warehouse, chosen.end)
    return chosen.start


def settle(warehouse: Warehouse, before: datetime) -> None:
    """Snapshots before a time can't be run again: let go of what is kept for that."""
    for table in DICTIONARIES:
        warehouse.settle_dictionary(table, before)
    forget_parsed(warehouse, before)


def retain(warehouse: Warehouse, day: datetime) -> None:
    """Drop dictionary rows last seen, and history days that start, before the edge.

    Files stay for readers that opened the tables before; ``Warehouse.vacuum`` deletes them later, outside a run.
    """
    edge = retention_edge(day)
    for table in DICTIONARIES:
        warehouse.trim_dictionary(table, edge)
    for table in HISTORIES:
        warehouse.drop_history(table, lambda ts: ts < edge)
    Manifest(warehouse).forget(edge)


# --- runs -------------------------------------------------------------------------------------------------


def _imported(waves: Waves, done: set[tuple[str, str]]) -> bool:
    return all(("import", table) in done for wave in waves for table in wave)


def run_full(
    warehouse: Warehouse, landing: DataFrame, ts: datetime, warehouse_file: str | None = None, strict: bool = False
) -> None:
    """First run of a day: all tables, changes since the last snapshot before midnight, upkeep."""
    manifest = Manifest(warehouse)
    with closing(SnapshotJob(warehouse, landing, ts, strict)) as job:
        done = manifest.done(job.ts)
        if ("begin", "full") not in done:
            manifest.mark(job.ts, "begin", "full")
        job.count_replies(manifest)
        if not _imported(FULL_IMPORT_WAVES, done):
            job.load_all(FULL_IMPORT_WAVES, job.stage_all(warehouse_file), manifest)
        day = midnight(job.ts)
        steps = {
            "changes": lambda: job.derive_changes(day),
            "compact": lambda: compact(warehouse, day),
            "retain": lambda: retain(warehouse, day),
        }
        if any(t < day for t in warehouse.snapshot_times("stocks")):
            for name, step in steps.items():
                if ("step", name) not in done:
                    step()
                    manifest.mark(job.ts, "step", name)
        manifest.mark(job.ts, "finish", "full")


def _load_point(
    job: SnapshotJob, manifest: Manifest | None, warehouse_file: str | None, replace: bool = False
) -> None:
    """Sizes, warehouses and stocks of the products seen on the day of the snapshot."""
    today = active_products(job.warehouse.as_of("products", job.ts), F.lit(midnight(job.ts)))
    frames = job.stage_stocks(today, warehouse_file)
    job.keep_extraction_rejects()
    job.load_all(POINT_IMPORT_WAVES, frames, manifest, replace)


def run_point(
    warehouse: Warehouse, landing: DataFrame, ts: datetime, warehouse_file: str | None = None, strict: bool = False
) -> None:
    """Later runs of a day: sizes, warehouses and stocks of the products seen today, and their changes."""
    manifest = Manifest(warehouse)
    with closing(SnapshotJob(warehouse, landing, ts, strict)) as job:
        done = manifest.done(job.ts)
        if ("begin", "point") not in done:
            manifest.mark(job.ts, "begin", "point")
        job.count_replies(manifest)
        if not _imported(POINT_IMPORT_WAVES, done):
            _load_point(job, manifest, warehouse_file)
        if ("step", "changes") not in done:
            job.derive_changes(job.ts)
            manifest.mark(job.ts, "step", "changes")
        manifest.mark(job.ts, "finish", "point")


def settled_until(warehouse: Warehouse) -> datetime | None:
    """End of the newest compacted day: snapshots before it can't be run again."""
    stored = warehouse.snapshot_times("stocks")
    compacted = compaction_day(stored, midnight(stored[-1])) if stored else None
    return compacted.end if compacted else None


def looking_up(dictionaries: set[str]) -> set[str]:
    """Tables whose rows resolve by these dictionaries, or by one that does."""
    found: set[str] = set()
    while True:
        more = {
            name for name, spec in TABLES.items() for lookup in spec.lookups
            if {lookup.dictionary, *([lookup.parent.dictionary] if lookup.parent else [])} & (dictionaries | found)
        }
        if more <= found:
            return found
        found |= more


def run_again(
    warehouse: Warehouse, landing: DataFrame, ts: datetime, warehouse_file: str | None = None, strict: bool = False
) -> list[datetime]:
    """Late or further replies of a snapshot: its job on all its replies, as if they had come in time.

    New replies are parsed; the snapshot's history and what it contributed to the dictionaries are replaced, newer rows of
    other snapshots stay. Where keys came or went, the later snapshots, which looked them up, are loaded again from their
    parsed replies, oldest first: a full run only its tables that look such keys up, unless it has new replies too. Then the
    pairs around all of them are derived anew. Returns the snapshots loaded.

    A snapshot stays a full or a point run as it began; one that never began is full if no run of its day was. A
    snapshot of a compacted day can't be taken in, as the day's changes are summed: its replies become rejects.
    """
    manifest = Manifest(warehouse)
    frozen = settled_until(warehouse)
    todo, loaded = [utc(ts)], []
    changed: set[str] = set()
    while todo:
        with closing(SnapshotJob(warehouse, landing, todo.pop(0), strict)) as job:
            if frozen is not None and job.ts < frozen:
                job.count_replies(manifest)
                job.refuse_all("day is compacted")
                return []
            done, seen = manifest.done(job.ts), job.landing.count()
            # A snapshot that was loaded from all these replies differs by the changed keys alone.
            loaded_all = bool(loaded) and manifest.counts().get(job.ts) == seen
            if ("begin", "full") in done or ("begin", "point") not in done and not manifest.full_done(job.ts):
                kind = "full"
                if loaded_all and ("finish", kind) in done:
                    some = looking_up(changed) | ({"warehouses"} if warehouse_file is not None else set())
                    frames = job.stage_some(some, warehouse_file)
                else:
                    frames = job.stage_all(warehouse_file)
                job.load_all(FULL_IMPORT_WAVES, frames, None, replace=True)
            else:
                kind = "point"
                _load_point(job, None, warehouse_file, replace=True)
            # Only now, so that a run that is lost before is done again.
            manifest.count(job.ts, seen)
            if ("finish", kind) not in done:
                manifest.mark(job.ts, "begin", kind)
                manifest.mark(job.ts, "finish", kind)
            loaded.append(job.ts)
            changed |= job.changed_keys
            if job.changed_keys and len(loaded) == 1:
                todo = [t for t in manifest.counts() if t > job.ts]
    rederive_changes(warehouse, loaded, frozen_before=frozen)
    return loaded


def catch_up(
    warehouse: Warehouse, landing: DataFrame, warehouse_file: str | None = None, strict: bool = False
) -> list[datetime]:
    """Run again every finished snapshot that got replies since its run; returns the snapshots loaded.

    Replies are only added to a landing, so their number tells. It comes from file footers where the landing is
    partitioned by snapshot.
    """
    manifest = Manifest(warehouse)
    known = manifest.counts()
    if not known:
        return []
    counted = landing.where(F.col("snapshot_ts") >= F.lit(min(known))).groupBy("snapshot_ts").agg(F.count("*").alias("n"))
    found = {utc(datetime.fromisoformat(r.ts)): r.n for r in counted.select(F.date_format("snapshot_ts", TIME).alias("ts"), "n").collect()}
    loaded: list[datetime] = []
    for ts in sorted(t for t, n in known.items() if found.get(t, 0) > n):
        if ts not in loaded and any(unit == "finish" for unit, _ in manifest.done(ts)):
            loaded += run_again(warehouse, landing, ts, warehouse_file, strict)
    return loaded


def import_files(warehouse: Warehouse, folder: str, ts: datetime, waves: Waves = FULL_IMPORT_WAVES, strict: bool = False) -> None:
    """Take a snapshot's staging files, one folder a table, into the tables; repeated lines and imports change nothing.

    Lines that are no rows, or rows of another snapshot, become rejects ``<table>-lines``; rows that don't resolve, the
    usual ones. A table without files is left as it is.
    """
    with closing(SnapshotJob(warehouse, empty_frame(warehouse.spark, LANDING), ts, strict)) as job:
        for wave in waves:
            present = [t for t in wave if warehouse.files.names(f"{folder}/{t}")]

            def load(table: str) -> None:
                spec = TABLES[table]
                lines = warehouse.spark.read.option("lineSep", "\n").text(f"{folder}/{table}")
                rows, bad = checked_lines(lines, spec, keep=lambda checked: job._written(f"{table}-lines", checked))
                own = F.col("timestamp") == F.lit(job.ts)
                other = to_lines(rows.where(~own), spec).withColumn("reason", F.lit("other snapshot"))
                job.keep_line_rejects(table, bad.unionByName(other))
                mine = rows.where(own)
                # History keys are one row each before they are loaded; a dictionary's load sees to it.
                job.load(table, distinct_on(mine, spec.key) if spec.is_history else mine)

            at_once(warehouse.spark, [lambda table=table: load(table) for table in present])


def run_due(
    warehouse: Warehouse, landing: DataFrame, now: datetime, warehouse_file: str | None = None,
    strict: bool = False, clock=lambda: datetime.now(timezone.utc),
) -> tuple[datetime, str] | None:
    """Do the run that is due at ``now``; None if there is none.

    A run that overruns its grid point also closes the point it ends in, which is then left out.
    """
    manifest = Manifest(warehouse)
    due = manifest.choose(now)
    if due is None:
        return None
    ts, kind = due
    (run_full if kind == "full" else run_point)(warehouse, landing, ts, warehouse_file, strict)
    end = grid_point(clock())
    if end > ts and midnight(end) == midnight(ts):
        manifest.mark(end, "finish", "skipped")
    return due
