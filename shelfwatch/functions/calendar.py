"""The three-hour snapshot grid.

Times without a zone argument follow the wall clock of the value itself: TIMESTAMP_NTZ as it is, TIMESTAMP
in the session zone. With ``zone`` the grid is laid out in that zone's local day.
"""

from __future__ import annotations

from datetime import datetime, time, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID_HOURS = 3


def utc(ts: datetime) -> datetime:
    """Driver-side times are aware and in UTC; a naive one is taken as UTC."""
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)


def midnight(ts: datetime, shift: int = 0) -> datetime:
    ts = utc(ts)
    return datetime.combine(ts.date() + timedelta(days=shift), time(), timezone.utc)


def grid_point(ts: datetime) -> datetime:
    ts = utc(ts)
    return midnight(ts) + timedelta(hours=ts.hour // GRID_HOURS * GRID_HOURS)


def _localise(ts: Column, zone: str | None) -> Column:
    local = ts.cast("timestamp_ntz")
    if zone is None:
        return local
    return F.convert_timezone(F.current_timezone(), F.lit(zone), local)


def _restore(local: Column, zone: str | None) -> Column:
    if zone is None:
        return local
    return F.convert_timezone(F.lit(zone), F.current_timezone(), local).cast("timestamp")


def _midnight(local: Column) -> Column:
    return local.cast("date").cast("timestamp_ntz")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n)


def day_start(ts: Column, shift: int = 0, zone: str | None = None) -> Column:
    """Midnight of the local day, ``shift`` days on."""
    local = _localise(ts, zone)
    return _restore(F.date_add(local.cast("date"), shift).cast("timestamp_ntz"), zone)


def point_floor(ts: Column, zone: str | None = None) -> Column:
    """Latest grid point not after ``ts``: 0, 3, ... 21 h of the local day."""
    local = _localise(ts, zone)
    hour = F.hour(local) - F.hour(local) % GRID_HOURS
    return _restore(_midnight(local) + _hours(hour), zone)


def next_point(ts: Column, zone: str | None = None) -> Column:
    """First grid point after ``ts``; from 21 h on that is the next midnight."""
    local = _localise(ts, zone)
    hour = F.hour(local) - F.hour(local) % GRID_HOURS + GRID_HOURS
    same_day = _midnight(local) + _hours(hour)
    return _restore(
        F.when(hour < 24, same_day).otherwise(F.date_add(local.cast("date"), 1).cast("timestamp_ntz")),
        zone,
    )


def partition_label(ts: Column, zone: str | None = None) -> Column:
    """Day label of a history partition, ``yyyyMMdd``."""
    return F.date_format(_localise(ts, zone), "yyyyMMdd")
