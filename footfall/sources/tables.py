"""Readers of the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import in_month
from footfall.schemas import DEVICE_STATE, FLOW_KEY, STATION_KEY, hourly_wide


def station_dim(source: DataFrame) -> DataFrame:
    """The station dimension (StationId, StationName) as text keys, one row per station."""
    return source.select(
        F.col("StationId").cast("string").alias("station_id"),
        F.col("StationName").cast("string").alias("station_name"),
    ).dropDuplicates(["station_id"])


def station_dim_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str]
) -> DataFrame:
    """The station dimension from a database; the caller supplies all connection settings."""
    return station_dim(spark.read.jdbc(url, table, properties=properties))


def hourly_month(
    spark: SparkSession, path: str, keys: list[str], year: int, month: int
) -> DataFrame:
    """One month of an hourly table; the date range prunes day partitions."""
    table = spark.read.schema(hourly_wide(keys)).parquet(path)
    return table.where(in_month(F.col("stat_date"), year, month))


def station_month(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """One month of the hourly station table."""
    return hourly_month(spark, path, STATION_KEY, year, month)


def flows_month(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """One month of the hourly flow table."""
    return hourly_month(spark, path, FLOW_KEY, year, month)


#: Values that Spark pushes to a file as they are; of more it pushes their least and greatest only.
_PUSHED = 10


def device_state(
    spark: SparkSession,
    path: str,
    day: dt.date | None = None,
    dev_id: str | Sequence[str] | None = None,
) -> DataFrame:
    """Stored device state: the whole table, one day partition, one device or some devices.

    Days are partitions. Devices are looked up by the sorted files' statistics and Bloom filters
    (``operators.sinks.save_state``); for more than some hundreds of them, join instead
    (``operators.state.lookup_state``).
    """
    table = spark.read.schema(DEVICE_STATE).parquet(path)
    if day is not None:
        table = table.where(F.col("start_date") == F.lit(day))
    if dev_id is not None:
        wanted = [dev_id] if isinstance(dev_id, str) else list(dev_id)
        groups = [wanted[i : i + _PUSHED] for i in range(0, len(wanted), _PUSHED)]
        table = table.where(reduce(or_, [F.col("dev_id").isin(g) for g in groups], F.lit(False)))
    return table
