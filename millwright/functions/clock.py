"""Shift calendar and wall-clock flags, all in the session (UTC) time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT_HOURS = 8
FIRST_SHIFT_HOUR = 6
CHANGEOVER_HOURS = (6, 14, 22)
CHANGEOVER_MINUTES = 15
COLD_START_HOUR = 9


def shift_of(ts: Column) -> Column:
    hour = F.hour(ts)
    return (
        F.when((hour >= 6) & (hour < 14), "MORNING")
        .when((hour >= 14) & (hour < 22), "AFTERNOON")
        .otherwise("NIGHT")
    )


def shift_start(ts: Column) -> Column:
    """Start of the shift instance a moment falls in.

    The three shifts are equally long and the first starts at 06:00, so the
    start is plain arithmetic; the night shift crosses midnight for free.
    """
    offset, length = FIRST_SHIFT_HOUR * 3600, SHIFT_HOURS * 3600
    ordinal = F.floor((F.unix_seconds(ts) - offset) / length)
    return F.timestamp_seconds(ordinal * length + offset)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def in_changeover(ts: Column) -> Column:
    """Strictly less than 15 minutes away from a shift change."""
    minute = minute_of_day(ts)
    flags = [F.abs(minute - hour * 60) < CHANGEOVER_MINUTES for hour in CHANGEOVER_HOURS]
    return flags[0] | flags[1] | flags[2]


def in_cold_start(ts: Column) -> Column:
    """Monday before 09:00."""
    return (F.weekday(ts) == 0) & (F.hour(ts) < COLD_START_HOUR)


def in_shift_startup(ts: Column, minutes: int = 15) -> Column:
    return F.unix_seconds(ts) - F.unix_seconds(shift_start(ts)) < minutes * 60


def in_utc(moment: datetime) -> datetime:
    """The moment with UTC as its zone; without a zone it already is UTC."""
    return moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def instant(moment: Column | datetime | None) -> Column:
    """A moment as a column; None is now."""
    if moment is None:
        return F.current_timestamp()
    return F.lit(in_utc(moment)) if isinstance(moment, datetime) else moment


def time_between(ts: Column, start=None, end=None) -> Column:
    """Closed time range; a bound that is None is left open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (ts >= instant(start))
    if end is not None:
        condition = condition & (ts <= instant(end))
    return condition


def newer_than(ts: Column, as_of, interval: str) -> Column:
    """``ts`` lies strictly inside the interval that ends at ``as_of``."""
    return ts > instant(as_of) - F.expr(f"INTERVAL {interval}")
