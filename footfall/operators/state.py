"""Device state: where and when a device was last counted, per event date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.schemas import KEEP_DAYS_BACK

# The three ways a visit writes the state row of its device-day.
STATE_WRITES = {"first": "insert", "revisit": "touch", "move": "move"}


def state_writes(visits: DataFrame) -> DataFrame:
    """One state write per visit: insert, touch (time only) or move (time and station)."""
    write = F.create_map(*[F.lit(x) for pair in STATE_WRITES.items() for x in pair])
    return visits.select(
        "dev_id",
        F.col("stat_date").alias("start_date"),
        F.col("event_ts").alias("last_datetime"),
        "station_id",
        "seq",
        write[F.col("kind")].alias("write"),
    )


def device_state(visits: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """State after the visits, and of device-days that only the prior state knows.

    A run of sightings starts with a visit, so the last visit has the last station. This is a
    plain aggregation with map-side partial results; no device-day is gathered anywhere.
    """
    columns = ["dev_id", "start_date", "last_datetime", "station_id"]
    rows = state_writes(visits).select(*columns, "seq")
    if prior is not None:
        stored = prior.select(*columns).withColumn("seq", F.lit(None).cast("long"))
        rows = rows.unionByName(stored)
    # A stored row (no seq) loses against any visit, even one with an earlier time.
    order = F.struct(F.col("seq").isNotNull(), "last_datetime", "seq")
    last = F.max_by(F.struct("last_datetime", "station_id"), order).alias("last")
    return rows.groupBy("dev_id", "start_date").agg(last).select("dev_id", "start_date", "last.*")


def expire_state(state: DataFrame, today: dt.date) -> DataFrame:
    """State rows still kept today: nothing three days old or older."""
    oldest = today - dt.timedelta(days=KEEP_DAYS_BACK)
    return state.where(F.col("start_date") >= F.lit(oldest))


def lookup_state(sightings: DataFrame, state: DataFrame) -> DataFrame:
    """Each sighting with the stored state of its device-day, if there is one.

    State has one row per device-day. A hot device-day makes a long left side of one join key;
    the adaptive skew join splits it and copies that one state row to each part.
    """
    stored = state.select(
        "dev_id",
        F.col("start_date").alias("event_date"),
        F.col("last_datetime").alias("stored_ts"),
        F.col("station_id").alias("stored_station_id"),
    )
    return sightings.join(stored, ["dev_id", "event_date"], "left")
