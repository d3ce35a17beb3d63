"""Find device-days that hold so many rows that one task should not handle them alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schemas import DEVICE_DAY

# A device-day below this many rows is sorted by one task without trouble.
HOT_ROWS = 2_000_000


def device_day_hash() -> Column:
    """64-bit hash of a device-day."""
    return F.xxhash64(*DEVICE_DAY)


def find_hot_device_days(sightings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(day_key, rows) of every device-day, by its hash, with ``hot_rows`` rows or more.

    Exact: rows are counted within tasks first, so the shuffle carries a key and a count, and
    there is no bound on how many are found.
    """
    counts = sightings.groupBy(device_day_hash().alias("day_key")).agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") >= hot_rows)
