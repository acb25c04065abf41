"""Event-time parsing and the statistics time ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens import params


def ntz_literal(value: str | dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (wall-clock, independent of the session zone)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def event_time(date: str | Column) -> Column:
    """Log ``Date`` string -> UTC wall-clock ``timestamp_ntz``; malformed -> null.

    Log dates look like ``2024-04-20T12:34:56.1234567Z``.  ``try_to_timestamp``
    reads the zone suffix (fractions past microseconds are cut) into an
    instant, and the wall clock is built from the instant's microseconds since
    the epoch, so no session zone (and no repeated autumn hour) comes into it.
    A malformed date gives null instead of failing the whole micro-batch.
    """
    c = F.col(date) if isinstance(date, str) else date
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(c)), _epoch())


def instant(wall: str | Column) -> Column:
    """The ``timestamp`` whose UTC wall clock is the given ``timestamp_ntz``, whatever the session zone."""
    c = F.col(wall) if isinstance(wall, str) else wall
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), c))


def _epoch() -> Column:
    return ntz_literal("1970-01-01 00:00:00")


def range_start(as_of: str | dt.datetime | Column, time_range: str) -> Column:
    """Start of a statistics range: ``as_of`` minus a week, a month or six months.

    Calendar arithmetic: 2024-03-31 minus one month is 2024-02-29.  An
    unknown range name gives ``as_of`` itself (an empty range).
    """
    base = as_of if isinstance(as_of, Column) else ntz_literal(as_of)
    interval = params.TIME_RANGES.get(time_range)
    return base - F.expr(interval) if interval else base


def pull_start_date(as_of: str | dt.datetime | Column,
                    overlap_days: int = params.PULL_OVERLAP_DAYS) -> Column:
    """First day (``yyyy-MM-dd``) an incremental pull asks for: ``as_of`` minus the overlap."""
    base = as_of if isinstance(as_of, Column) else ntz_literal(as_of)
    return F.date_format(F.date_sub(F.to_date(base), overlap_days), params.PULL_DATE_FORMAT)
