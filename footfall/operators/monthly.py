"""Monthly totals from the wide hourly tables, and their upsert.

The two rollups treat a NULL hour differently, on purpose. The station rollup adds the sums of
the hour columns: a NULL cell is skipped, but an hour that is NULL in every row makes the total
NULL. The flow rollup sums the row totals: one NULL cell skips its whole row. A total that comes
out NULL is stored as 0.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import in_month, row_sum24
from footfall.schemas import FLOW_KEY, HOUR_COLUMNS, STATION_KEY


def month_start(day: Column) -> Column:
    """First day of a date's month."""
    return F.to_date(F.trunc(day, "MM"))


def filter_month(table: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one month."""
    return table.where(in_month(F.col("stat_date"), year, month))


def representative_date(table: DataFrame, keys: list[str]) -> DataFrame:
    """The one date shown per key and month: the earliest."""
    grouped = table.groupBy(*keys, month_start(F.col("stat_date")).alias("month"))
    return grouped.agg(F.min("stat_date").alias("stat_date")).select(*keys, "stat_date")


def distinct_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that have a row in a month, one row each."""
    return table.select(*keys, month_start(F.col("stat_date")).alias("month")).distinct()


def _rollup(hourly: DataFrame, keys: list[str], total: Column) -> DataFrame:
    """One row per key and month, dated as ``representative_date``."""
    grouped = hourly.groupBy(*keys, month_start(F.col("stat_date")).alias("month"))
    return grouped.agg(
        F.min("stat_date").alias("stat_date"), F.coalesce(total, F.lit(0)).alias("count")
    ).select(*keys, "stat_date", "count")


def station_monthly(hourly: DataFrame) -> DataFrame:
    """Visits per station and month, for whatever months the table holds."""
    return _rollup(hourly, STATION_KEY, reduce(add, [F.sum(c) for c in HOUR_COLUMNS]))


def flows_monthly(hourly: DataFrame) -> DataFrame:
    """Flows per station pair and month."""
    return _rollup(hourly, FLOW_KEY, F.sum(row_sum24()))


def months_present(monthly: DataFrame) -> DataFrame:
    """The months a monthly table has any row for."""
    return monthly.select(month_start(F.col("stat_date")).alias("month")).distinct()


def exists_month(monthly: DataFrame, year: int, month: int) -> bool:
    """Whether the table has any row of the month."""
    return not filter_month(monthly, year, month).isEmpty()


def _with_month(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("month", month_start(F.col("stat_date")))


def update_existing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows with the new totals of their key and month; dates stay, new keys are ignored."""
    totals = _with_month(new).select(*keys, "month", F.col("count").alias("new_count"))
    joined = _with_month(old).join(totals, [*keys, "month"], "left")
    return joined.select(*keys, "stat_date", F.coalesce("new_count", "count").alias("count"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], mode: str = "merge") -> DataFrame:
    """The monthly table after saving new totals.

    ``merge`` updates known keys and inserts new ones. ``update_or_insert`` inserts only into
    months that have no row yet; a month that exists has its known keys updated, nothing more.
    """
    updated = update_existing(old, new, keys)
    fresh = _with_month(new)
    if mode == "merge":
        inserted = fresh.join(_with_month(old).select(*keys, "month"), [*keys, "month"], "left_anti")
    elif mode == "update_or_insert":
        # One row per calendar month: a century has 1,200, so this side is always small.
        inserted = fresh.join(F.broadcast(months_present(old)), "month", "left_anti")
    else:
        raise ValueError(f"unknown upsert mode {mode!r}")
    return updated.unionByName(inserted.select(*keys, "stat_date", "count"))
