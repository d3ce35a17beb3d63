"""The scheduled jobs. The caller's scheduler decides when; "now" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from footfall.functions.times import local_day, month_before
from footfall.operators.grid import flow_grid, station_grid
from footfall.operators.monthly import flows_monthly, station_monthly
from footfall.operators.sinks import ensure_hourly, save_monthly
from footfall.schemas import FLOW_KEY, STATION_KEY
from footfall.sources.tables import flows_month, station_month


def grid_days(as_of: dt.datetime, tz_delta_hours: int = 0) -> list[dt.date]:
    """The days whose rows must exist: today and tomorrow in local time."""
    today = local_day(as_of, tz_delta_hours)
    return [today, today + dt.timedelta(days=1)]


def hourly_refresh(
    stations: DataFrame,
    station_path: str,
    flow_path: str,
    as_of: dt.datetime,
    tz_delta_hours: int = 0,
) -> None:
    """Give every listed station and station pair its zero row for today and tomorrow."""
    days = grid_days(as_of, tz_delta_hours)
    ensure_hourly(station_grid(stations, days), station_path, STATION_KEY, days)
    ensure_hourly(flow_grid(stations, days), flow_path, FLOW_KEY, days)


def monthly_refresh(
    spark: SparkSession,
    station_path: str,
    flow_path: str,
    station_month_path: str,
    flow_month_path: str,
    as_of: dt.datetime,
    tz_delta_hours: int = 0,
    mode: str = "merge",
) -> None:
    """Roll last month's hourly tables up and save the totals; repeatable."""
    year, month = month_before(as_of, tz_delta_hours)
    stations = station_monthly(station_month(spark, station_path, year, month))
    save_monthly(stations, station_month_path, STATION_KEY, mode)
    flows = flows_monthly(flows_month(spark, flow_path, year, month))
    save_monthly(flows, flow_month_path, FLOW_KEY, mode)
