"""Stock snapshots derived from ``events``: changes, compaction, calendar and retention.

A snapshot is the last event of each (user, event type) in a three-hour point; quantity is its value in cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwatch.contract.tables import table
from shelfwatch.functions.calendar import day_start, next_point, partition_label, point_floor
from shelfwatch.operators.changes import (
    at_snapshot,
    first_snapshot,
    history_changes,
    next_snapshots,
    previous_snapshot,
    snapshot_changes,
    split_changes,
)
from shelfwatch.operators.compact import compact_changes
from shelfwatch.operators.dedupe import distinct_on, merge_by_key
from shelfwatch.operators.retention import active_products, keep_days_since, keep_seen_since

KEYS = ["user_id", "event_type"]

_POINT = "date_trunc('day', ts) + to_hours(3 * (hour(ts) // 3))"
_SNAP = f"""
points AS (SELECT *, {_POINT} AS point FROM events),
snap AS (
  SELECT point AS timestamp, user_id, event_type, CAST(round(value * 100) AS INTEGER) AS quantity
  FROM points
  QUALIFY row_number() OVER (PARTITION BY point, user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
)"""
_CHANGES = f"""{_SNAP},
steps AS (
  SELECT timestamp, lead(timestamp) OVER (ORDER BY timestamp) AS timestamp_to
  FROM (SELECT DISTINCT timestamp FROM snap)
),
changes AS (
  SELECT a.timestamp, b.timestamp AS timestamp_to, a.user_id, a.event_type, b.quantity - a.quantity AS diff
  FROM snap a JOIN steps s ON s.timestamp = a.timestamp
  JOIN snap b ON b.timestamp = s.timestamp_to AND b.user_id = a.user_id AND b.event_type = a.event_type
  WHERE b.quantity <> a.quantity
)"""


def snapshots_of(events: DataFrame, last: bool = True) -> DataFrame:
    direction = F.desc if last else F.asc
    pointed = events.select(
        point_floor(F.col("ts")).alias("timestamp"), *KEYS, "ts", "event_id", "value"
    )
    chosen = distinct_on(pointed, ["timestamp", *KEYS], [direction("ts"), direction("event_id")], total=True)
    return chosen.select("timestamp", *KEYS, F.round(F.col("value") * 100).cast("int").alias("quantity"))


def event_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots_of(table(spark, folder, "events"))


def event_points(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct snapshot times; reads the time column alone."""
    return table(spark, folder, "events").select(point_floor(F.col("ts")).alias("timestamp")).distinct()


def event_changes(spark: SparkSession, folder: str) -> DataFrame:
    pairs = next_snapshots(event_points(spark, folder))
    return history_changes(event_snapshots(spark, folder), pairs, KEYS)


def with_kind(changes: DataFrame) -> DataFrame:
    """Orders and refills in one frame, for the report."""
    kind = F.when(F.col("diff") < 0, "order").otherwise("refill")
    rest = [c for c in changes.columns if c != "diff"]
    return changes.select(*rest, kind.alias("kind"), F.abs("diff").alias("quantity"))


def stock_changes(spark, folder):
    return with_kind(event_changes(spark, folder))


STOCK_CHANGES_SQL = f"""
WITH {_CHANGES}
SELECT timestamp, timestamp_to, user_id, event_type,
       CASE WHEN diff < 0 THEN 'order' ELSE 'refill' END AS kind, abs(diff) AS quantity
FROM changes
"""


def latest_changes(spark, folder):
    """Changes of the newest snapshot against the one before it."""
    snaps, points = event_snapshots(spark, folder), event_points(spark, folder)
    newest = points.agg(F.max("timestamp")).scalar()
    previous = previous_snapshot(points, newest).scalar()
    return with_kind(snapshot_changes(at_snapshot(snaps, previous), at_snapshot(snaps, newest), KEYS))


LATEST_CHANGES_SQL = f"""
WITH {_SNAP},
pair AS (
  SELECT max(timestamp) AS newest,
         (SELECT max(timestamp) FROM snap WHERE timestamp < (SELECT max(timestamp) FROM snap)) AS previous
  FROM snap
)
SELECT a.timestamp, b.timestamp AS timestamp_to, a.user_id, a.event_type,
       CASE WHEN b.quantity < a.quantity THEN 'order' ELSE 'refill' END AS kind,
       abs(b.quantity - a.quantity) AS quantity
FROM pair
JOIN snap a ON a.timestamp = pair.previous
LEFT JOIN snap b ON b.user_id = a.user_id AND b.event_type = a.event_type AND b.timestamp = pair.newest
WHERE b.quantity - a.quantity <> 0
"""


def _compacted(spark, folder, which):
    facts = split_changes(event_changes(spark, folder))[which].withColumn("day", partition_label(F.col("timestamp")))
    return compact_changes(facts, ["day", *KEYS])


def orders_compacted(spark, folder):
    return _compacted(spark, folder, 0)


def refills_compacted(spark, folder):
    return _compacted(spark, folder, 1)


def _compacted_sql(condition):
    return f"""
    WITH {_CHANGES}
    SELECT min(timestamp) AS timestamp, max(timestamp_to) AS timestamp_to,
           strftime(timestamp, '%Y%m%d') AS day, user_id, event_type, CAST(sum(abs(diff)) AS INTEGER) AS quantity
    FROM changes WHERE {condition}
    GROUP BY strftime(timestamp, '%Y%m%d'), user_id, event_type
    """


def _days(spark, folder):
    """First and last snapshot of every data day; one row a day."""
    return (
        event_points(spark, folder)
        .groupBy(day_start(F.col("timestamp")).alias("day"))
        .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    )


def stocks_first_of_day(spark, folder):
    firsts = _days(spark, folder).select(F.col("first").alias("timestamp"))
    return event_snapshots(spark, folder).join(F.broadcast(firsts), "timestamp", "left_semi")


STOCKS_FIRST_OF_DAY_SQL = f"""
WITH {_SNAP}
SELECT s.* FROM snap s
JOIN (SELECT min(timestamp) AS first FROM snap GROUP BY date_trunc('day', timestamp)) d ON s.timestamp = d.first
"""


def previous_of_day(spark, folder):
    """For every data day, the newest snapshot before its midnight."""
    by_day = Window.orderBy("day")
    return _days(spark, folder).select("day", F.lag("last").over(by_day).alias("previous_snapshot"))


PREVIOUS_OF_DAY_SQL = f"""
WITH {_SNAP}, days AS (SELECT DISTINCT date_trunc('day', timestamp) AS day FROM snap)
SELECT day, (SELECT max(timestamp) FROM snap WHERE timestamp < day) AS previous_snapshot FROM days
"""


def compaction_days(spark, folder):
    """For every data day, the day its first run compacts and that day's first snapshot."""
    by_day = Window.orderBy("day")
    return _days(spark, folder).select(
        "day", F.lag("day", 2).over(by_day).alias("compacted_day"), F.lag("first", 2).over(by_day).alias("first_snapshot")
    )


COMPACTION_DAYS_SQL = f"""
WITH {_SNAP},
days AS (SELECT DISTINCT date_trunc('day', timestamp) AS day FROM snap),
last AS (SELECT day, (SELECT max(timestamp) FROM snap WHERE timestamp < day) AS last FROM days),
second AS (
  SELECT day, date_trunc('day', (SELECT max(timestamp) FROM snap WHERE timestamp < date_trunc('day', last)))
    AS compacted_day
  FROM last
)
SELECT day, compacted_day, (SELECT min(timestamp) FROM snap WHERE timestamp >= compacted_day) AS first_snapshot
FROM second
"""


def snapshot_pairs(spark, folder):
    return next_snapshots(event_points(spark, folder))


SNAPSHOT_PAIRS_SQL = f"""
WITH {_SNAP}
SELECT timestamp, timestamp_to FROM (
  SELECT timestamp, lead(timestamp) OVER (ORDER BY timestamp) AS timestamp_to
  FROM (SELECT DISTINCT timestamp FROM snap)
) WHERE timestamp_to IS NOT NULL
"""


def snapshot_bounds(spark, folder):
    """Newest snapshot before, and oldest at or after, the middle of the month."""
    points = event_points(spark, folder)
    middle = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return (
        previous_snapshot(points, middle).withColumn("bound", F.lit("before"))
        .unionByName(first_snapshot(points, middle).withColumn("bound", F.lit("from")))
        .unionByName(at_snapshot(points, middle).withColumn("bound", F.lit("at")))
    )


SNAPSHOT_BOUNDS_SQL = f"""
WITH {_SNAP}
SELECT max(timestamp) AS timestamp, 'before' AS bound FROM snap WHERE timestamp < TIMESTAMP '2024-01-15'
UNION ALL
SELECT min(timestamp), 'from' FROM snap WHERE timestamp >= TIMESTAMP '2024-01-15'
UNION ALL
SELECT DISTINCT timestamp, 'at' FROM snap WHERE timestamp = TIMESTAMP '2024-01-15'
"""

_MIDDLE = "2024-01-15"


def history_upsert(spark, folder):
    """Stored: first event of every point. Staged: last event of every point of the second half."""
    events = table(spark, folder, "events")
    staged = snapshots_of(events).where(F.col("timestamp") >= F.lit(_MIDDLE).cast("timestamp_ntz"))
    return merge_by_key(snapshots_of(events, last=False), staged, ["timestamp", *KEYS])


HISTORY_UPSERT_SQL = f"""
WITH {_SNAP},
stored AS (
  SELECT point AS timestamp, user_id, event_type, CAST(round(value * 100) AS INTEGER) AS quantity
  FROM points
  QUALIFY row_number() OVER (PARTITION BY point, user_id, event_type ORDER BY ts, event_id) = 1
)
SELECT timestamp, user_id, event_type, coalesce(n.quantity, o.quantity) AS quantity
FROM stored o FULL JOIN (SELECT * FROM snap WHERE timestamp >= TIMESTAMP '{_MIDDLE}') n
USING (timestamp, user_id, event_type)
"""


def grid_of_events(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id", point_floor(ts).alias("point"), next_point(ts).alias("next"),
        day_start(ts).alias("day"), day_start(ts, -30).alias("edge"), partition_label(ts).alias("label"),
    )


GRID_OF_EVENTS_SQL = f"""
SELECT event_id, time_bucket(INTERVAL '3 hours', ts) AS point,
       time_bucket(INTERVAL '3 hours', ts) + INTERVAL '3 hours' AS next,
       date_trunc('day', ts) AS day, date_trunc('day', ts) - INTERVAL '30 days' AS edge,
       strftime(ts, '%Y%m%d') AS label
FROM events
"""


def _last_seen(spark, folder):
    return table(spark, folder, "events").groupBy("user_id").agg(F.max("ts").alias("last_timestamp"))


def _newest_day(spark, folder, shift=0):
    return table(spark, folder, "events").agg(day_start(F.max("ts"), shift)).scalar()


def dictionary_retention(spark, folder):
    """Users seen in the week before the newest event's day, or on it."""
    return keep_seen_since(_last_seen(spark, folder), _newest_day(spark, folder, -7))


def history_retention(spark, folder):
    return keep_days_since(event_snapshots(spark, folder), _newest_day(spark, folder, -7))


def active_users(spark, folder):
    """Users seen since the start of the newest event's day."""
    return active_products(_last_seen(spark, folder), _newest_day(spark, folder)).select("user_id")


_EDGE = "(SELECT date_trunc('day', max(ts)) - INTERVAL '7 days' FROM events)"

QUERIES = {
    "stock_changes": (stock_changes, STOCK_CHANGES_SQL),
    "latest_changes": (latest_changes, LATEST_CHANGES_SQL),
    "orders_compacted": (orders_compacted, _compacted_sql("diff < 0")),
    "refills_compacted": (refills_compacted, _compacted_sql("diff > 0")),
    "stocks_first_of_day": (stocks_first_of_day, STOCKS_FIRST_OF_DAY_SQL),
    "previous_snapshot": (previous_of_day, PREVIOUS_OF_DAY_SQL),
    "compaction_day": (compaction_days, COMPACTION_DAYS_SQL),
    "snapshot_pairs": (snapshot_pairs, SNAPSHOT_PAIRS_SQL),
    "snapshot_bounds": (snapshot_bounds, SNAPSHOT_BOUNDS_SQL),
    "history_upsert": (history_upsert, HISTORY_UPSERT_SQL),
    "point_grid": (grid_of_events, GRID_OF_EVENTS_SQL),
    "dictionary_retention": (
        dictionary_retention,
        f"""SELECT user_id, max(ts) AS last_timestamp FROM events GROUP BY user_id HAVING max(ts) >= {_EDGE}""",
    ),
    "history_retention": (
        history_retention, f"WITH {_SNAP} SELECT * FROM snap WHERE timestamp >= {_EDGE}",
    ),
    "active_products": (
        active_users,
        """SELECT user_id FROM events GROUP BY user_id
           HAVING max(ts) >= (SELECT date_trunc('day', max(ts)) FROM events)""",
    ),
}
