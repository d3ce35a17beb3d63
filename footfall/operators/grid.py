"""Zero grids: one row per station and day, and per ordered station pair and day.

A grid is united with the counted rows and aggregated once, instead of being joined to them:
listed keys without counts get zeros, and counted keys that are not listed keep their rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.schemas import FLOW_KEY, HOUR_COLUMNS, STATION_KEY

# Pairs are built per hash bucket of the destination, of about this many stations each.
BUCKET_STATIONS = 32


def _days(days: list[dt.date]):
    return F.explode(F.array(*[F.lit(d) for d in days])).alias("stat_date")


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """All days from first to last, both included."""
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def station_grid(stations: DataFrame, days: list[dt.date]) -> DataFrame:
    """Every listed station on each day."""
    return stations.select("station_id").distinct().select("station_id", _days(days))


def no_self_pair(pairs: DataFrame) -> DataFrame:
    """Drop pairs of a station with itself."""
    return pairs.where(F.col("src_station_id") != F.col("dst_station_id"))


def flow_grid(stations: DataFrame, days: list[dt.date]) -> DataFrame:
    """Every ordered pair of different listed stations on each day.

    The n * (n - 1) pairs are the wanted rows themselves. An equi-join on the destination's hash
    bucket makes them: each source is copied once per bucket, and no station is broadcast. The
    number of buckets follows the number of stations.
    """
    ids = stations.select("station_id").distinct()
    counted = ids.withColumn("buckets", ids.agg(F.ceil(F.count("*") / BUCKET_STATIONS)).scalar())
    sources = counted.select(
        F.col("station_id").alias("src_station_id"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"),
    )
    destinations = counted.select(
        F.col("station_id").alias("dst_station_id"),
        F.pmod(F.xxhash64("station_id"), F.col("buckets")).alias("bucket"),
    )
    pairs = no_self_pair(sources.join(destinations.hint("merge"), "bucket"))
    return pairs.select(*FLOW_KEY, _days(days))


def zero_rows(grid: DataFrame) -> DataFrame:
    """Grid keys as wide rows of zeros."""
    return grid.withColumns({c: F.lit(0).cast("long") for c in HOUR_COLUMNS})


def densify(wide: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """Wide counts plus a zero row for each grid key that has none; stored rows stay as they are."""
    counted = wide.withColumn("_stored", F.lit(True))
    listed = zero_rows(grid).withColumn("_stored", F.lit(False))
    best = F.max_by(F.struct(*HOUR_COLUMNS), "_stored").alias("hours")
    both = counted.unionByName(listed).groupBy(*keys, "stat_date").agg(best)
    return both.select(*keys, "stat_date", "hours.*")


def densify_station(wide: DataFrame, stations: DataFrame, days: list[dt.date]) -> DataFrame:
    """Dense hourly station table of the given days."""
    return densify(wide, station_grid(stations, days), STATION_KEY)


def densify_flows(wide: DataFrame, stations: DataFrame, days: list[dt.date]) -> DataFrame:
    """Dense hourly flow table of the given days."""
    return densify(wide, flow_grid(stations, days), FLOW_KEY)


def insert_missing(grid: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Zero rows for the grid keys that the table has no row for."""
    on = [*keys, "stat_date"]
    return zero_rows(grid.join(table.select(*on), on, "left_anti"))
