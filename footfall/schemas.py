"""Schemas and fixed values shared by every job.

All timestamps are ``timestamp_ntz``: event times arrive already in local time, so no
session time zone may move them to another hour or day.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the counting rules.
GAP_MINUTES = 30  # a re-sighting counts only strictly after this gap
KEEP_DAYS_BACK = 2  # oldest event date still accepted, counted from today
KEEP_DAYS_AHEAD = 1  # newest event date accepted
LOG_FLUSH_ROWS = 1000  # rows per bulk write of the device log
LOG_FLUSH_SECONDS = 5  # longest wait before a bulk write

HOURS = range(24)
HOUR_COLUMNS = [f"hour_{h:02d}" for h in HOURS]

# Text fields, then whole-number fields, of the two JSON messages.
MESSAGE_STRINGS = ["sensorID", "sensorType", "stationID", "deviceID", "datetime"]
MESSAGE_INTS = ["power", "dsStatus"]

STATION_KEY = ["station_id"]
FLOW_KEY = ["src_station_id", "dst_station_id"]
DEVICE_DAY = ["dev_id", "event_date"]

# One raw message: `seq` is the arrival order, unique per message.
MESSAGE = T.StructType(
    [T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())]
)

SIGHTING = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("dev_id", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("event_date", T.DateType()),
    ]
)

DEVICE_STATE = T.StructType(
    [
        T.StructField("dev_id", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("last_datetime", T.TimestampNTZType()),
        T.StructField("station_id", T.StringType()),
    ]
)

VISIT_FACT = T.StructType(
    [
        T.StructField("dev_id", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("prev_station_id", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
        T.StructField("stat_date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("kind", T.StringType()),
    ]
)

DEVICE_LOG = T.StructType(
    [
        T.StructField("SensorId", T.IntegerType()),
        T.StructField("Mac", T.StringType()),
        T.StructField("Rssi", T.ByteType()),
        T.StructField("TimeNow", T.TimestampNTZType()),
    ]
)


def hourly_wide(keys: list[str]) -> T.StructType:
    """Schema of an hourly table with one column per hour of the day."""
    return T.StructType(
        [T.StructField(k, T.StringType()) for k in keys]
        + [T.StructField("stat_date", T.DateType())]
        + [T.StructField(c, T.LongType()) for c in HOUR_COLUMNS]
    )


def monthly(keys: list[str]) -> T.StructType:
    """Schema of a monthly table."""
    return T.StructType(
        [T.StructField(k, T.StringType()) for k in keys]
        + [T.StructField("stat_date", T.DateType()), T.StructField("count", T.LongType())]
    )
