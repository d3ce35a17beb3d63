"""Scalar functions on dates, times and counters.

Everything here is a built-in expression over ``timestamp_ntz`` and ``date``. Functions that
would silently pass through the session time zone (``date_format``, ``date_trunc``) are avoided.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schemas import HOUR_COLUMNS

# Fixed text formats: "yyyy-MM-dd HH:mm:ss" and an optionally signed whole number.
DATETIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
INTEGER_PATTERN = r"^[+-]?\d+$"


def parse_datetime(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a zone-less timestamp; NULL when malformed."""
    return F.when(text.rlike(DATETIME_PATTERN), text.try_cast("timestamp_ntz"))


def format_datetime(ts: Column) -> Column:
    """Zone-less timestamp to ``yyyy-MM-dd HH:mm:ss``."""
    return F.substring(ts.cast("string"), 1, 19)


def format_date(day: Column) -> Column:
    """Date to ``yyyy-MM-dd``."""
    return day.cast("string")


def whole_seconds(ts: Column) -> Column:
    """Cut a zone-less timestamp to the second, the precision of the messages."""
    fraction = F.extract(F.lit("SECOND"), ts) % 1
    return ts - F.make_dt_interval(secs=fraction)


def event_date(ts: Column) -> Column:
    """Calendar day of a zone-less timestamp."""
    return F.to_date(ts)


def hour_of(ts: Column) -> Column:
    """Hour of day, 0 to 23."""
    return F.hour(ts)


def hour_column(hour: Column) -> Column:
    """Name of the hourly column an hour is counted in."""
    return F.format_string("hour_%02d", hour)


def partition_name(day: Column) -> Column:
    """Name of the day partition, for example ``p2018_03_31``."""
    return F.concat(F.lit("p"), F.translate(day.cast("string"), "-", "_"))


def short_partition_name(day: Column) -> Column:
    """Name of the day partition with a two-digit year, for example ``p180331``."""
    return F.concat(F.lit("p"), F.translate(F.substring(day.cast("string"), 3, 8), "-", ""))


def shift_hours(ts: Column, hours: int) -> Column:
    """Move a wall-clock time by whole hours (used on "now", never on event times)."""
    return ts + F.make_dt_interval(hours=F.lit(hours))


def last_month(day: Column) -> Column:
    """First day of the month before the given day."""
    return F.to_date(F.trunc(F.add_months(day, -1), "MM"))


def day_offset(day: Column, days: int) -> Column:
    """Move a date by whole days."""
    return F.date_add(day, days)


def to_int(text: Column) -> Column:
    """Text to int; NULL unless it is a plain whole number in range."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("int"))


def row_sum24() -> Column:
    """Sum of the 24 hour columns of one row; NULL as soon as one of them is NULL."""
    return reduce(add, [F.col(c) for c in HOUR_COLUMNS])


def month_range(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First day of the month and first day of the next one."""
    first = dt.date(year, month, 1)
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return first, following


def in_month(day: Column, year: int, month: int) -> Column:
    """Half-open date range, so that partitions and row groups can be skipped."""
    first, following = month_range(year, month)
    return (day >= F.lit(first)) & (day < F.lit(following))


def month_before(as_of: dt.datetime, tz_delta_hours: int = 0) -> tuple[int, int]:
    """Year and month of the month before ``as_of`` shifted by the zone offset."""
    shifted = (as_of + dt.timedelta(hours=tz_delta_hours)).date()
    last = shifted.replace(day=1) - dt.timedelta(days=1)
    return last.year, last.month


def local_day(as_of: dt.datetime, tz_delta_hours: int = 0) -> dt.date:
    """Calendar day of ``as_of`` shifted by the zone offset."""
    return (as_of + dt.timedelta(hours=tz_delta_hours)).date()
