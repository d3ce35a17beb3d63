"""The accepted span of event dates: two days back to one day ahead of today."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schemas import KEEP_DAYS_AHEAD, KEEP_DAYS_BACK


def _bounds(today: dt.date) -> tuple[Column, Column]:
    back, ahead = dt.timedelta(days=KEEP_DAYS_BACK), dt.timedelta(days=KEEP_DAYS_AHEAD)
    return F.lit(today - back), F.lit(today + ahead)


def filter_horizon(sightings: DataFrame, today: dt.date) -> DataFrame:
    """Sightings whose event date is accepted today."""
    return sightings.where(F.col("event_date").between(*_bounds(today)))


def late_drop(sightings: DataFrame, today: dt.date) -> DataFrame:
    """Sightings too old to count, with the reason, for a side table."""
    oldest, _ = _bounds(today)
    late = sightings.where(F.col("event_date") < oldest)
    return late.withColumn("reason", F.lit("late"))


def future_drop(sightings: DataFrame, today: dt.date) -> DataFrame:
    """Sightings too far ahead to count, with the reason, for a side table."""
    _, newest = _bounds(today)
    early = sightings.where(F.col("event_date") > newest)
    return early.withColumn("reason", F.lit("future"))


def batch_day(tz_delta_hours: int = 0) -> Column:
    """The local day of now; in a stream, of the micro-batch's own time, also when it is run again."""
    seconds = F.unix_timestamp(F.current_timestamp()) + tz_delta_hours * 3600
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))


def judged(sightings: DataFrame, today: Column) -> DataFrame:
    """Sightings with ``reason``: late, future, or NULL for those accepted on the given day."""
    early = F.col("event_date") < F.date_sub(today, KEEP_DAYS_BACK)
    ahead = F.col("event_date") > F.date_add(today, KEEP_DAYS_AHEAD)
    return sightings.withColumn("reason", F.when(early, "late").when(ahead, "future"))
