"""The given tables in the role of sightings, messages and stations.

``events``: one sighting per event, by user at the event's type; in the dense variant by event
type at a band of the event's value, which gives few devices with long runs at one station.
``orders``: one sighting per order, by order status at the order's priority, over many
months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import event_date, format_datetime, whole_seconds
from footfall.sources import folders

UNUSED_STATION = "kiosk"  # listed, never seen: shows up as zero rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sightings(
    rows: DataFrame, seq: str, device: Column, station: Column, ts: Column, more: list[str] = []
) -> DataFrame:
    return rows.select(
        F.col(seq).alias("seq"),
        F.lit("1").alias("sensor_id"),
        station.alias("station_id"),
        device.cast("string").alias("dev_id"),
        ts.cast("timestamp_ntz").alias("event_ts"),
        *more,
    ).withColumn("event_date", event_date(F.col("event_ts")))


def event_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen at event types."""
    return _sightings(
        table(spark, sf_dir, "events"),
        "event_id",
        F.col("user_id"),
        F.col("event_type"),
        whole_seconds(F.col("ts")),
    )


def stray_events(events: DataFrame) -> DataFrame:
    """Two copies of the first proper view: from a clock seven years ahead, and ten days older."""
    k = F.get_json_object("props", "$.k").cast("int")
    first = events.where((F.col("event_type") == "view") & (k < 90)).orderBy("event_id").limit(1)
    ahead = first.withColumns({"event_id": F.lit(-1).cast("long"), "ts": F.expr("ts + INTERVAL 7 YEAR")})
    late = first.withColumns({"event_id": F.lit(-2).cast("long"), "ts": F.expr("ts - INTERVAL 10 DAY")})
    return ahead.unionByName(late)


def arriving_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen at event types, with the day of arrival; the strays arrive with their original."""
    events = table(spark, sf_dir, "events").withColumn("arrived", event_date(F.col("ts").cast("timestamp_ntz")))
    both = events.unionByName(stray_events(events))
    ts = whole_seconds(F.col("ts"))
    return _sightings(both, "event_id", F.col("user_id"), F.col("event_type"), ts, ["arrived"])


#: Files that a replayed stream takes in at a time.
REPLAY_FILES = 12


def replayed_sightings(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """``arriving_sightings`` as a stream of files in order of arrival.

    The files lie in a folder per day of arrival. A day may have several, also in different
    micro-batches, between which the order is that of arrival: so files are cut from one order by
    day and time. A stream takes files by their modification time, which is made to follow it.
    """
    rows = arriving_sightings(spark, sf_dir)
    order = ["arrived", "event_ts", "seq"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.write.partitionBy("arrived").mode("append").parquet(path)
    days = [f"{path}/{name}" for name in folders.children(spark, path) if name.startswith("arrived=")]
    files = [f"{day}/{name}" for day in days for name in folders.children(spark, day)]
    for place, file in enumerate(files):
        folders.stamp(spark, file, 1_700_000_000_000 + place * 1000)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", REPLAY_FILES).parquet(path)


def dense_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types seen at value bands: five devices, long runs, many re-sightings."""
    band = F.concat(F.lit("band-"), F.floor(F.col("value") / 100).cast("string"))
    return _sightings(
        table(spark, sf_dir, "events"),
        "event_id",
        F.col("event_type"),
        band,
        whole_seconds(F.col("ts")),
    )


def order_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statuses seen at order priorities, over many months."""
    return _sightings(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
        F.col("o_orderdate"),
    )


def event_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types and one unused station."""
    unused = spark.range(1).select(F.lit(UNUSED_STATION).alias("station_id"))
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("station_id"))
    return types.distinct().unionByName(unused)


def event_messages(
    spark: SparkSession, sf_dir: str, log: bool = False, strays: bool = False
) -> DataFrame:
    """Events, and the strays where asked, as JSON messages, some broken in a way that follows from their own values.

    ``k`` from the event's props decides: errors with k under 20 lose their last two characters,
    clicks with k under 10 carry the station as a number, views with k of 90 and more have a
    ``T`` in their time, and in the log variant sign-ups with k under 5 name their sensor in words
    and purchases carry the station's name.
    """
    events = table(spark, sf_dir, "events")
    events = events.unionByName(stray_events(events)) if strays else events
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    text = format_datetime(F.col("ts"))
    late_t = (kind == "view") & (k >= 90)
    numeric = (kind == "click") & (k < 10)
    sensor = F.floor(F.col("value")).cast("string")
    fields = {"sensorType": F.lit("gate")}
    if log:
        sensor = F.when((kind == "signup") & (k < 5), "north-gate").otherwise(sensor)
        fields["stationName"] = F.when(kind == "purchase", F.upper(kind))
    fields |= {
        "deviceID": F.col("user_id").cast("string"),
        "power": -k,
        "dsStatus": F.lit(1),
        "datetime": F.when(late_t, F.translate(text, " ", "T")).otherwise(text),
    }
    shared = [column.alias(name) for name, column in fields.items()]
    head = sensor.alias("sensorID")
    as_text = F.to_json(F.struct(head, kind.alias("stationID"), *shared))
    as_number = F.to_json(F.struct(head, k.alias("stationID"), *shared))
    value = F.when(numeric, as_number).otherwise(as_text)
    cut = (kind == "error") & (k < 20)
    value = F.when(cut, value.substr(F.lit(1), F.length(value) - 2)).otherwise(value)
    return events.select(F.col("event_id").alias("seq"), value.alias("value"))
