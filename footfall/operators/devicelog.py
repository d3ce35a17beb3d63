"""The raw device log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_KEY = ["SensorId", "Mac", "TimeNow"]


def dedup_device_log(rows: DataFrame) -> DataFrame:
    """One row per key, the first to arrive. Copies are merged before the shuffle."""
    # A plain value, NULL included, is merged in a hash map; a struct would be sorted first.
    first = F.min_by("Rssi", "seq").alias("Rssi")
    return rows.groupBy(*LOG_KEY).agg(first).select("SensorId", "Mac", "Rssi", "TimeNow")


def new_log_rows(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Deduplicated rows whose key the stored log does not have yet."""
    return dedup_device_log(rows).join(stored.select(*LOG_KEY), LOG_KEY, "left_anti")
