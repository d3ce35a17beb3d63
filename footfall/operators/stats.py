"""Hourly statistics of stations and flows, long and wide.

Every count is a hash aggregation with map-side partial sums, so a station that holds a third
of all visits reaches the shuffle as one small row per task and hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schemas import FLOW_KEY, HOUR_COLUMNS, HOURS, STATION_KEY


def hourly_counts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts per key, date and hour."""
    counted = facts.groupBy(*keys, "stat_date", "hour").agg(F.count("*").alias("count"))
    return counted.select(*keys, "stat_date", "hour", "count")


def station_hourly(visits: DataFrame) -> DataFrame:
    """Visits per station, date and hour of the counted sighting."""
    return hourly_counts(visits, STATION_KEY)


def flows_hourly(flows: DataFrame) -> DataFrame:
    """Flows per station pair, date and hour of the arriving sighting."""
    return hourly_counts(flows, FLOW_KEY)


def _spread_hours(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """One row per key and date with 24 hour columns, 0 where nothing was counted.

    The hours are named, so no job runs to find them. The counts per key, date and hour are
    summed before the shuffle; only they are turned.
    """
    turned = rows.groupBy(*keys, "stat_date").pivot("hour", list(HOURS)).agg(value)
    named = [F.coalesce(F.col(str(h)), F.lit(0)).alias(c) for h, c in zip(HOURS, HOUR_COLUMNS)]
    return turned.select(*keys, "stat_date", *named)


def pivot_hours(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts to the wide hourly form."""
    return _spread_hours(facts, keys, F.count(F.lit(1)))


def pivot_hours_station(visits: DataFrame) -> DataFrame:
    """Wide hourly station table."""
    return pivot_hours(visits, STATION_KEY)


def pivot_hours_flow(flows: DataFrame) -> DataFrame:
    """Wide hourly flow table."""
    return pivot_hours(flows, FLOW_KEY)


def widen(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Long hourly counts to the wide form; several rows of one hour add up."""
    return _spread_hours(counts, keys, F.sum("count"))


def lengthen(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Wide hourly table back to one row per key, date and hour."""
    hours = F.array(
        *[F.struct(F.lit(h).alias("hour"), F.col(c).alias("count"))
          for h, c in zip(HOURS, HOUR_COLUMNS)]
    )
    return wide.select(*keys, "stat_date", F.inline(hours))


def add_hours(table: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Add new counts to a wide table; keys without a row get one.

    Both sides have one row per key and date. A counter that is NULL in the table stays NULL, as
    adding to NULL does.
    """
    on = [*keys, "stat_date"]
    old = table.withColumn("stored", F.lit(True))
    new = delta.select(*on, *[F.col(c).alias(f"new_{c}") for c in HOUR_COLUMNS])
    sums = [
        F.when(F.col("stored"), F.col(c) + F.coalesce(f"new_{c}", F.lit(0)))
        .otherwise(F.col(f"new_{c}"))
        .alias(c)
        for c in HOUR_COLUMNS
    ]
    return old.join(new, on, "full_outer").select(*on, *sums)
