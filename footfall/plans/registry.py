"""Registered queries: every operator over the given tables.

Each query takes (spark, sf_dir). Dates and timestamps are shown as text, the way the stored
statistics name them, so that results compare the same under any session time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import times
from footfall.operators import (
    decode,
    devicelog,
    grid,
    horizon,
    monthly,
    sinks,
    skew,
    state,
    stats,
    visits,
)
from footfall.plans.refresh import hourly_refresh, monthly_refresh
from footfall.schemas import (
    FLOW_KEY,
    HOUR_COLUMNS,
    STATION_KEY,
    VISIT_FACT,
    hourly_wide,
)
from footfall.session import scratch_path
from footfall.sources import messages, samples, tables
from footfall.streaming import devicelog as log_stream
from footfall.streaming.ingest import Ingest
from footfall.streaming import visits as visit_stream

Query = Callable[[SparkSession, str], DataFrame]

JANUARY = grid.days_between(dt.date(2024, 1, 1), dt.date(2024, 1, 31))
MID_JANUARY = dt.date(2024, 1, 15)
TODAY = dt.date(2024, 1, 20)
LAST_DAYS = dt.datetime(2024, 1, 29, 22, 30)  # with +3 hours: 30 and 31 January
LATE_MONTHS = dt.date(1997, 1, 1)  # months from here on are missing at first
FEBRUARY = dt.datetime(2024, 2, 1, 0, 5)
SIGHTING_COLUMNS = ["seq", "station_id", "dev_id", "event_ts", "event_date"]

_QUERIES: dict[str, Query] = {}


def _shown(rows: DataFrame) -> DataFrame:
    as_text = {}
    for field in rows.schema.fields:
        if isinstance(field.dataType, (T.TimestampNTZType, T.DateType)):
            as_text[field.name] = F.substring(F.col(field.name).cast("string"), 1, 19)
    return rows.withColumns(as_text)


def query(function: Query) -> Query:
    """Register a query under the function's name."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _shown(function(spark, sf_dir))

    _QUERIES[function.__name__] = shown
    return function


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return dict(_QUERIES)


# Facts that many queries start from.


def event_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.count_visits(samples.event_sightings(spark, sf_dir))


def dense_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.count_visits(samples.dense_sightings(spark, sf_dir))


def order_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.count_visits(samples.order_sightings(spark, sf_dir))


def event_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.flows_from_visits(event_visits(spark, sf_dir))


def order_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.flows_from_visits(order_visits(spark, sf_dir))


def station_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.pivot_hours_station(event_visits(spark, sf_dir))


def flow_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.pivot_hours_flow(event_flows(spark, sf_dir))


def _stored(rows: DataFrame, label: str, by: str) -> str:
    """Write a partitioned table below the shared folder and return its path."""
    path = scratch_path(rows.sparkSession, label)
    sinks.append_rows(rows, path, [by])
    return path


# Scalar functions.


@query
def parse_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = times.format_datetime(F.col("ts"))
    text = F.when(F.col("event_type") == "view", F.translate(text, " ", "T")).otherwise(text)
    events = samples.table(spark, sf_dir, "events")
    return events.select("event_id", times.parse_datetime(text).alias("parsed"))


@query
def format_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.table(spark, sf_dir, "events").select(
        "event_id",
        times.format_datetime(F.col("ts")).alias("datetime"),
        times.format_date(times.event_date(F.col("ts"))).alias("date"),
    )


@query
def to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", times.event_date(F.col("o_orderdate")).alias("event_date"))


@query
def hour_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = samples.table(spark, sf_dir, "events")
    return events.select("event_id", times.hour_of(F.col("ts")).alias("hour"))


@query
def hour_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = times.hour_column(times.hour_of(F.col("ts"))).alias("hour_column")
    return samples.table(spark, sf_dir, "events").select("event_id", name)


@query
def partition_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = times.event_date(F.col("o_orderdate"))
    return samples.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.partition_name(day).alias("name"),
        times.short_partition_name(day).alias("short_name"),
    )


@query
def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = times.event_date(F.col("o_orderdate"))
    orders = samples.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"))


@query
def shift_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = samples.table(spark, sf_dir, "events")
    return events.select("event_id", times.shift_hours(F.col("ts"), 3).alias("shifted"))


@query
def last_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = times.last_month(times.event_date(F.col("o_orderdate")))
    orders = samples.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.year(before).alias("year"), F.month(before).alias("month"))


@query
def day_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = times.event_date(F.col("o_orderdate"))
    return samples.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.day_offset(day, 1).alias("day_plus_1"),
        *[times.day_offset(day, -n).alias(f"day_minus_{n}") for n in (1, 2, 3, 4)],
    )


@query
def to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return samples.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.to_int(F.substring(priority, 1, 1)).alias("digit"),
        times.to_int(priority).alias("words"),
    )


@query
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.from_json("props", "k int")
    return samples.table(spark, sf_dir, "events").select("event_id", fields["k"].alias("k"))


@query
def row_sum24(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = station_wide(spark, sf_dir)
    return wide.select("station_id", "stat_date", times.row_sum24().alias("total"))


# Sources, decoding and the device log.


def _streamed_messages(spark: SparkSession, sf_dir: str, log: bool) -> DataFrame:
    """Land the messages as files, read those as a stream, and return what arrived."""
    base = scratch_path(spark, "messages")
    samples.event_messages(spark, sf_dir, log).write.parquet(f"{base}/in")
    query = (
        messages.message_file_stream(spark, f"{base}/in")
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return messages.message_files(spark, f"{base}/out")


@query
def src_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_messages(spark, sf_dir, log=False)


@query
def src_device_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_messages(spark, sf_dir, log=True)


@query
def src_station_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = samples.table(spark, sf_dir, "nation")
    return tables.station_dim(
        nation.select(F.col("n_nationkey").alias("StationId"), F.col("n_name").alias("StationName"))
    )


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_sighting(samples.event_messages(spark, sf_dir))


def _decoded_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_device_log(samples.event_messages(spark, sf_dir, log=True))


@query
def decode_sighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.accepted(_decoded(spark, sf_dir)).drop("value", "event_ts")


@query
def decode_device_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.accepted(_decoded_log(spark, sf_dir)).drop("value", "event_ts")


@query
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.quarantine_bad(_decoded(spark, sf_dir))


@query
def project_sighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.project_sighting(_decoded(spark, sf_dir))


def _int_rssi(rows: DataFrame) -> DataFrame:
    return rows.withColumn("Rssi", F.col("Rssi").cast("int"))


@query
def project_device_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _int_rssi(decode.project_device_log(_decoded_log(spark, sf_dir)))


@query
def dedup_device_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row arrives twice, the second time with another signal strength."""
    rows = decode.project_device_log(_decoded_log(spark, sf_dir))
    again = {"seq": F.col("seq") + 1_000_000_000_000, "Rssi": F.lit(0).cast("tinyint")}
    arrivals = [F.struct(*[c.get(name, F.col(name)).alias(name) for name in rows.columns]) for c in ({}, again)]
    return _int_rssi(devicelog.dedup_device_log(rows.select(F.inline(F.array(*arrivals)))))


def _logged_stream(spark: SparkSession, sf_dir: str) -> log_stream.DeviceLog:
    """The log stream over all messages, two strays among them, in two micro-batches.

    The second brings every message again, and gathers what the first has stored.
    """
    base = scratch_path(spark, "log")
    job = log_stream.DeviceLog(f"{base}/out", buckets=8, close_every=1)
    for _ in range(2):
        rows = samples.event_messages(spark, sf_dir, log=True, strays=True)
        rows.write.mode("append").parquet(f"{base}/in")
        stream = messages.message_file_stream(spark, f"{base}/in", max_files_per_trigger=None)
        job.start(stream, f"{base}/checkpoint", availableNow=True).awaitTermination()
    return job


@query
def snk_device_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored log: every accepted row once, whatever its day."""
    return _int_rssi(_logged_stream(spark, sf_dir).rows(spark))


@query
def snk_device_log_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log stream's rejected messages, as often as they came."""
    return _logged_stream(spark, sf_dir).rejected(spark)


# Counting rules.


@query
def visit_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visits_of_kind(event_visits(spark, sf_dir), "first")


@query
def visit_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visits_of_kind(dense_visits(spark, sf_dir), "revisit")


@query
def visit_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visits_of_kind(event_visits(spark, sf_dir), "move")


@query
def visit_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    sightings = samples.dense_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    return visits.ignored_sightings(sightings, dense_visits(spark, sf_dir))


@query
def count_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_visits(spark, sf_dir)


@query
def count_visits_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_visits(spark, sf_dir)


@query
def count_visits_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count with the larger device-days treated as hot: split by second and seq."""
    sightings = samples.dense_sightings(spark, sf_dir)
    days = sightings.groupBy("dev_id", "event_date").count()
    typical = int(days.agg(F.avg("count")).first()[0])
    hot = skew.find_hot_device_days(sightings, typical)
    return visits.count_visits(sightings, hot=hot, seq_block=1000)


@query
def filter_gap30(spark: SparkSession, sf_dir: str) -> DataFrame:
    sightings = samples.dense_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    return visits.past_gap_sightings(sightings, dense_visits(spark, sf_dir))


@query
def filter_same_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    sightings = samples.dense_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    return visits.same_station_sightings(sightings, dense_visits(spark, sf_dir))


@query
def flow_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_flows(spark, sf_dir)


# Device state.


def _morning_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    morning = samples.event_sightings(spark, sf_dir).where(F.hour("event_ts") < 12)
    return state.device_state(visits.count_visits(morning))


@query
def join_prev_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Afternoons counted from the state their mornings left."""
    afternoon = samples.event_sightings(spark, sf_dir).where(F.hour("event_ts") >= 12)
    return visits.count_visits(afternoon, _morning_state(spark, sf_dir))


@query
def lookup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Afternoon sightings with the state their morning left, or none."""
    sightings = samples.event_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    afternoon = sightings.where(F.hour("event_ts") >= 12)
    return state.lookup_state(afternoon, _morning_state(spark, sf_dir))


@query
def device_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mornings first, then afternoons on top of the morning state."""
    prior = _morning_state(spark, sf_dir)
    afternoon = samples.event_sightings(spark, sf_dir).where(F.hour("event_ts") >= 12)
    return state.device_state(visits.count_visits(afternoon, prior), prior)


@query
def src_device_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "state")
    sinks.save_state(state.device_state(event_visits(spark, sf_dir)), path)
    return tables.device_state(spark, path, MID_JANUARY)


@query
def expire_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.expire_state(state.device_state(event_visits(spark, sf_dir)), TODAY)


def _state_writes(spark: SparkSession, sf_dir: str, write: str) -> DataFrame:
    return state.state_writes(dense_visits(spark, sf_dir)).where(F.col("write") == write)


@query
def snk_device_state_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_writes(spark, sf_dir, "insert")


@query
def snk_device_state_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_writes(spark, sf_dir, "touch")


@query
def snk_device_state_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_writes(spark, sf_dir, "move")


# The accepted span of event dates.


@query
def filter_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    sightings = samples.event_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    return horizon.filter_horizon(sightings, TODAY)


@query
def late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    sightings = samples.event_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    return horizon.late_drop(sightings, TODAY)


@query
def future_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    sightings = samples.event_sightings(spark, sf_dir).select(*SIGHTING_COLUMNS)
    return horizon.future_drop(sightings, TODAY)


# Streams.


def _replayed(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Sightings in order of arrival, some files at a time, each judged by the day it arrived on.

    Two strays come with the rest: one from a clock seven years ahead, one ten days late.
    """
    stream = samples.replayed_sightings(spark, sf_dir, f"{base}/in")
    return visit_stream.count_visits_stream(stream, today=F.col("arrived"))


def _counted_stream(spark: SparkSession, sf_dir: str) -> str:
    """Sightings through the keyed state; the folder with their table and the checkpoint."""
    base = scratch_path(spark, "stream")
    rows = _replayed(spark, sf_dir, base)
    visit_stream.write_judged(rows, f"{base}/judged", f"{base}/checkpoint", availableNow=True).awaitTermination()
    return base


@query
def st_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits counted by the keyed streaming state."""
    return visit_stream.read_judged(spark, f"{_counted_stream(spark, sf_dir)}/judged", True)


@query
def st_visits_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sightings that the keyed stream has set aside."""
    rows = visit_stream.read_judged(spark, f"{_counted_stream(spark, sf_dir)}/judged", False)
    return rows.select(*SIGHTING_COLUMNS, "reason")


@query
def st_visits_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Afternoons streamed from the state that a batch count of their mornings left."""
    base = scratch_path(spark, "stream")
    stream = samples.replayed_sightings(spark, sf_dir, f"{base}/in")
    afternoon = stream.where((F.hour("event_ts") >= 12) & (F.col("seq") >= 0))
    rows = visit_stream.count_visits_stream(afternoon, prior=_morning_state(spark, sf_dir))
    visit_stream.write_judged(rows, f"{base}/judged", f"{base}/checkpoint", availableNow=True).awaitTermination()
    return visit_stream.read_judged(spark, f"{base}/judged", True)


@query
def st_device_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device state looked up in the checkpoint of the keyed stream; days that are over are gone."""
    return visit_stream.stored_state(spark, f"{_counted_stream(spark, sf_dir)}/checkpoint")


def _hourly_of_stream(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    base = scratch_path(spark, "stream")
    hours = visit_stream.hourly_stream(_replayed(spark, sf_dir, base), keys)
    visit_stream.write_facts(hours, f"{base}/hours", f"{base}/checkpoint", availableNow=True).awaitTermination()
    schema = ", ".join(f"{key} string" for key in keys) + ", stat_date date, hour int, count long"
    return spark.read.schema(schema).parquet(f"{base}/hours")


@query
def st_station_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits per station and hour, counted behind the keyed operator; hours that can still change are out."""
    return _hourly_of_stream(spark, sf_dir, STATION_KEY)


@query
def st_flows_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows per station pair and hour, likewise."""
    return _hourly_of_stream(spark, sf_dir, FLOW_KEY)


def _dense_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, value, event_date) of the dense variant."""
    fields = F.struct(
        F.col("sensor_id").alias("sensorID"),
        F.lit("gate").alias("sensorType"),
        F.col("station_id").alias("stationID"),
        F.col("dev_id").alias("deviceID"),
        F.lit(-50).alias("power"),
        F.lit(1).alias("dsStatus"),
        times.format_datetime(F.col("event_ts")).alias("datetime"),
    )
    rows = samples.dense_sightings(spark, sf_dir)
    return rows.select("seq", F.to_json(fields).alias("value"), "event_date")


@query
def st_microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the dense variant in two micro-batches, each all files of half of the days."""
    base = scratch_path(spark, "ingest")
    rows = _dense_messages(spark, sf_dir)
    job = Ingest(f"{base}/out")
    first = F.col("event_date") < F.lit(MID_JANUARY)
    for half in (first, ~first):
        rows.where(half).select("seq", "value").write.mode("append").parquet(f"{base}/in")
        stream = messages.message_file_stream(spark, f"{base}/in", max_files_per_trigger=None)
        job.start(stream, f"{base}/checkpoint", availableNow=True).awaitTermination()
    return job.visits(spark)


@query
def st_microbatch_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side table of a micro-batch judged by 20 January."""
    job = Ingest(scratch_path(spark, "ingest"), today=lambda: TODAY)
    job.run_batch(_dense_messages(spark, sf_dir).select("seq", "value"), 0)
    return job.dropped(spark).select(*SIGHTING_COLUMNS, "reason")


# Hourly tables.


@query
def station_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.station_hourly(event_visits(spark, sf_dir))


@query
def flows_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.flows_hourly(event_flows(spark, sf_dir))


@query
def pivot_hours_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_wide(spark, sf_dir)


@query
def pivot_hours_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_wide(spark, sf_dir)


def _added_halves(spark: SparkSession, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Count mornings into a stored table, then afternoons on top, and these once more."""
    path = scratch_path(spark, "hourly")
    facts = sinks.staged(facts, "facts")
    morning = F.col("hour") < 12
    for batch, half in ((0, morning), (1, ~morning), (1, ~morning)):
        sinks.add_hourly(stats.pivot_hours(facts.where(half), keys), path, keys, batch)
    return spark.read.schema(hourly_wide(keys)).parquet(path)


@query
def snk_station_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _added_halves(spark, event_visits(spark, sf_dir), STATION_KEY)


@query
def snk_flow_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _added_halves(spark, event_flows(spark, sf_dir), FLOW_KEY)


@query
def densify_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = samples.event_stations(spark, sf_dir)
    return grid.densify_station(station_wide(spark, sf_dir), stations, JANUARY)


@query
def densify_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = samples.event_stations(spark, sf_dir)
    return grid.densify_flows(flow_wide(spark, sf_dir), stations, JANUARY)


@query
def filter_no_self_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.flow_grid(samples.event_stations(spark, sf_dir), JANUARY)


@query
def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = grid.flow_grid(samples.event_stations(spark, sf_dir), JANUARY)
    return grid.insert_missing(pairs, flow_wide(spark, sf_dir), FLOW_KEY)


@query
def snk_station_hour_ensure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero rows added to a stored table, twice: the second time finds nothing to add."""
    path = _stored(station_wide(spark, sf_dir), "hourly", "stat_date")
    rows = grid.station_grid(samples.event_stations(spark, sf_dir), JANUARY)
    sinks.ensure_hourly(rows, path, STATION_KEY, JANUARY)
    sinks.ensure_hourly(rows, path, STATION_KEY, JANUARY)
    return spark.read.schema(hourly_wide(STATION_KEY)).parquet(path)


@query
def snk_flow_hour_ensure(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(flow_wide(spark, sf_dir), "hourly", "stat_date")
    rows = grid.flow_grid(samples.event_stations(spark, sf_dir), JANUARY)
    sinks.ensure_hourly(rows, path, FLOW_KEY, JANUARY)
    return spark.read.schema(hourly_wide(FLOW_KEY)).parquet(path)


@query
def hourly_refresh_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hourly tables after the refresh of 30 January, local time."""
    station_path = _stored(station_wide(spark, sf_dir), "hourly", "stat_date")
    flow_path = _stored(flow_wide(spark, sf_dir), "hourly", "stat_date")
    stations = samples.event_stations(spark, sf_dir)
    hourly_refresh(stations, station_path, flow_path, LAST_DAYS, tz_delta_hours=3)
    station_rows = spark.read.schema(hourly_wide(STATION_KEY)).parquet(station_path).select(
        F.col("station_id").alias("src_station_id"),
        F.col("station_id").alias("dst_station_id"),
        "stat_date",
        *HOUR_COLUMNS,
    )
    return station_rows.unionByName(spark.read.schema(hourly_wide(FLOW_KEY)).parquet(flow_path))


@query
def filter_key_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(station_wide(spark, sf_dir), "hourly", "stat_date")
    table = spark.read.schema(hourly_wide(STATION_KEY)).parquet(path)
    return table.where((F.col("station_id") == "view") & (F.col("stat_date") == F.lit(MID_JANUARY)))


# Months.


def _order_station_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.pivot_hours_station(order_visits(spark, sf_dir))


def _order_flow_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.pivot_hours_flow(order_flows(spark, sf_dir))


def _first_half(wide: DataFrame) -> DataFrame:
    return wide.where(F.dayofmonth("stat_date") <= 15)


@query
def station_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.station_monthly(_order_station_wide(spark, sf_dir))


@query
def flows_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.flows_monthly(_order_flow_wide(spark, sf_dir))


def _with_null_hours(wide: DataFrame) -> DataFrame:
    """NULL at midnight on every third day, and at seven in even months."""
    return wide.withColumns(
        {
            "hour_00": F.when(F.dayofmonth("stat_date") % 3 != 0, F.col("hour_00")),
            "hour_07": F.when(F.month("stat_date") % 2 != 0, F.col("hour_07")),
        }
    )


@query
def station_monthly_null_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.station_monthly(_with_null_hours(_order_station_wide(spark, sf_dir)))


@query
def flows_monthly_null_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.flows_monthly(_with_null_hours(_order_flow_wide(spark, sf_dir)))


@query
def representative_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.representative_date(_order_station_wide(spark, sf_dir), STATION_KEY)


@query
def distinct_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = monthly.flows_monthly(_order_flow_wide(spark, sf_dir))
    return monthly.distinct_keys(table, FLOW_KEY)


@query
def exists_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months for which the monthly table has rows."""
    return monthly.months_present(monthly.station_monthly(_order_station_wide(spark, sf_dir)))


@query
def filter_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.filter_month(_order_station_wide(spark, sf_dir), 1998, 7)


@query
def src_station_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(_order_station_wide(spark, sf_dir), "hourly", "stat_date")
    return tables.station_month(spark, path, 1998, 7)


@query
def src_flows_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(_order_flow_wide(spark, sf_dir), "hourly", "stat_date")
    return tables.flows_month(spark, path, 1998, 7)


@query
def update_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _order_flow_wide(spark, sf_dir)
    old = monthly.flows_monthly(_first_half(wide))
    return monthly.update_existing(old, monthly.flows_monthly(wide), FLOW_KEY)


def _upserted(
    spark: SparkSession, wide: DataFrame, rollup, keys: list[str], mode: str = "merge"
) -> DataFrame:
    """Save the totals of half months (but for the last years), then those of whole months, twice."""
    path = scratch_path(spark, "monthly")
    wide = sinks.staged(wide, "hourly")
    early = _first_half(wide)
    if mode != "merge":
        early = early.where(F.col("stat_date") < F.lit(LATE_MONTHS))
    sinks.save_monthly(rollup(early), path, keys, mode)
    sinks.save_monthly(rollup(wide), path, keys, mode)
    sinks.save_monthly(rollup(wide), path, keys, mode)
    return sinks.read_monthly(spark, path, keys)


@query
def snk_station_month_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _order_station_wide(spark, sf_dir)
    return _upserted(spark, wide, monthly.station_monthly, STATION_KEY)


@query
def snk_flows_month_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, _order_flow_wide(spark, sf_dir), monthly.flows_monthly, FLOW_KEY)


@query
def snk_station_month_update_or_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _order_station_wide(spark, sf_dir)
    return _upserted(spark, wide, monthly.station_monthly, STATION_KEY, "update_or_insert")


@query
def snk_flows_month_update_or_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _order_flow_wide(spark, sf_dir)
    return _upserted(spark, wide, monthly.flows_monthly, FLOW_KEY, "update_or_insert")


@query
def monthly_refresh_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both monthly tables after the refresh of 1 February."""
    paths = {
        "station": _stored(station_wide(spark, sf_dir), "hourly", "stat_date"),
        "flow": _stored(flow_wide(spark, sf_dir), "hourly", "stat_date"),
        "station_month": scratch_path(spark, "monthly"),
        "flow_month": scratch_path(spark, "monthly"),
    }
    monthly_refresh(spark, *paths.values(), as_of=FEBRUARY)
    stations = sinks.read_monthly(spark, paths["station_month"], STATION_KEY)
    flows = sinks.read_monthly(spark, paths["flow_month"], FLOW_KEY)
    both = stations.select(
        F.col("station_id").alias("src_station_id"),
        F.col("station_id").alias("dst_station_id"),
        "stat_date",
        "count",
    )
    return both.unionByName(flows)


# These two share their job's name, which the imports above already use.
_QUERIES["hourly_refresh"] = _QUERIES.pop("hourly_refresh_tables")
_QUERIES["monthly_refresh"] = _QUERIES.pop("monthly_refresh_tables")
