"""Counting visits in a stream, with keyed state per device and event date.

A device's state is small, (last counted second, station). The state store keeps it between
micro-batches, and an event-time timer clears it once its day can no longer be accepted. Inside a
micro-batch the order is (event_ts, seq); between micro-batches it is the order of arrival, so a
late sighting at another station counts and moves the last counted time back.

Every key of the state store costs a worker several calls to it in a micro-batch, far more than
the counting, and a device-day has few sightings. So a day's devices share BUCKETS keys by their
hash: a key's state has one entry for each of its devices, is read and written once in a batch and
cleared by one timer. However many devices a batch brings, the calls are at most some BUCKETS a
day.

A row handed to keyed Python state, or back, is taken apart cell by cell, which also costs far more
than the counting. So the tasks that read sightings gather those of a key and hour, some hundred
thousand sightings at a time, into one Arrow batch in a binary cell (``_packed``). The counter takes
such packs in and gives the counted sightings of an hour out as arrays, which Spark explodes. A pack
has the event time of its newest sighting: the watermark is the same as sighting by sighting, and a
pack counts as older than it only once all of its sightings are.

Likewise every partition of the state costs a task in every micro-batch: a store to open and commit, a
worker to start, a file per day to write, most of a second in all, however few sightings come. A stream
takes as many partitions as the cluster has cores, not as many as the session's shuffles, whose number
follows the size of a table and not that of a micro-batch.

One bucket's share of one micro-batch is handled by one task, as keyed state demands. Its size is bounded by the
admission limit of the source, never by the length of the stream. Catching up on a long backlog
is a batch job: ``streaming.ingest`` counts each micro-batch with the batch operator, which splits
hot device-days; the state it leaves can start a stream.

One query takes one decision per sighting. Given a day to judge by (that of the micro-batch, which
the offset log keeps), every sighting is either counted by the rules or passed on with the reason
why it is not accepted, and both go to one table by one sink. A sighting set aside touches no state
and stands for the day it is judged on before the watermark, so a bad clock can't move that; its
rows are spread over several keys, so a flood of them from one device is no hot key. What is
accepted on a day is never older than the watermark as long as days arrive in order.

State can be handed in (``prior``: device state that a batch job or another stream has left) and
looked up while the stream runs (``stored_state``, Spark's state data source over the checkpoint).
Hourly counts can follow the counting in the same query (``hourly_stream``): a windowed aggregate
behind the keyed operator, which gives an hour out once the watermark has passed it.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from footfall.functions.times import hour_of
from footfall.operators.horizon import judged
from footfall.schemas import (
    DEVICE_DAY,
    DEVICE_STATE,
    FLOW_KEY,
    GAP_MINUTES,
    KEEP_DAYS_AHEAD,
    KEEP_DAYS_BACK,
    SIGHTING,
    STATION_KEY,
    VISIT_FACT,
)
from footfall.streaming.metrics import observe_judged

# An accepted sighting is never older than this below the newest accepted one.
WATERMARK = f"{KEEP_DAYS_BACK + KEEP_DAYS_AHEAD + 1} days"

# Keys that a day's devices share. Part of the layout of a checkpoint: a stream can't change it.
BUCKETS = 256
# Sightings that a reading task holds while it packs them.
PACK_ROWS = 1 << 18
VISIT_KINDS = ["first", "revisit", "move"]
REASONS = ["late", "future"]
# Buckets below zero hold sightings that are set aside.
_KEY = ["event_date", "bucket"]

# Cells of a packed sighting; a date is days since 1970.
_PACK = pa.schema(
    [
        ("sensor_id", pa.string()),
        ("dev_id", pa.string()),
        ("station_id", pa.string()),
        ("seq", pa.int64()),
        ("reason", pa.string()),
        ("judged_day", pa.int32()),
        ("event_s", pa.int64()),
    ]
)
_PACKED = "event_date date, bucket int, newest_s long, pack binary"
# Parallel arrays, an entry per sighting of one hour.
_ARRAYS = {
    "sensor_id": T.StringType(),
    "dev_id": T.StringType(),
    "station_id": T.StringType(),
    "prev_station_id": T.StringType(),
    "event_s": T.LongType(),
    "seq": T.LongType(),
    "kind": T.StringType(),
    "judged_day": T.IntegerType(),
}
_OUTPUT = T.StructType(
    [T.StructField(name, T.ArrayType(kind)) for name, kind in _ARRAYS.items()]
    + [T.StructField("event_time", T.TimestampType())]
)
# Parallel arrays, an entry per device.
_STATE = T.StructType(
    [
        T.StructField("dev_id", T.ArrayType(T.StringType())),
        T.StructField("last_s", T.ArrayType(T.LongType())),
        T.StructField("station_id", T.ArrayType(T.StringType())),
    ]
)
_DAY_SECONDS = 86_400
_HOUR_SECONDS = 3600
_NULL = -(1 << 62)
_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A column of whole numbers or dates, nulls below all others."""
    days = column.cast(pa.int32()) if pa.types.is_date(column.type) else column
    return days.cast(pa.int64()).fill_null(_NULL).to_numpy()


def _pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The sightings of some batches, a row per key and hour."""
    rows = pa.Table.from_batches(batches)
    day, bucket, time = (_numbers(rows[name]) for name in (*_KEY, "time_s"))
    hour = time // _HOUR_SECONDS
    order = np.lexsort((time, hour, bucket, day))
    rows = rows.take(order).combine_chunks()
    groups = np.stack([day, bucket, hour])[:, order]
    starts = np.flatnonzero(np.append(True, (groups[:, 1:] != groups[:, :-1]).any(axis=0)))
    ends = np.append(starts[1:], len(order))
    (cells,) = rows.select(_PACK.names).cast(_PACK).to_batches()
    packs = [cells.slice(i, j - i).serialize().to_pybytes() for i, j in zip(starts.tolist(), ends.tolist())]
    newest = rows["time_s"].take(ends - 1)  # the last of an hour
    columns = [rows[name].take(starts).combine_chunks() for name in _KEY]
    columns += [newest.combine_chunks(), pa.array(packs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=[*_KEY, "newest_s", "pack"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= PACK_ROWS:
            yield _pack(held)
            held, count = [], 0
    if held:
        yield _pack(held)


def _unpacked(packs: list[bytes]) -> dict[str, np.ndarray]:
    """The cells of some packs' sightings; of Python objects where there are nulls or text."""
    rows = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(pack), _PACK) for pack in packs], _PACK)
    cells = {}
    for name, column in zip(rows.column_names, rows.columns):
        if column.null_count and not pa.types.is_string(column.type):  # would become floats
            cells[name] = np.array(column.to_pylist(), dtype=object)
        else:
            cells[name] = column.to_numpy(zero_copy_only=False)
    return cells


class VisitCounter(StatefulProcessor):
    """The counting rules over one bucket of the device-days of a day."""

    def __init__(self, gap_minutes: int):
        self.gap = gap_minutes * 60

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last_counted", _STATE)

    def _clear_after(self, day: dt.date) -> None:
        self.handle.registerTimer(((day - dt.date(1970, 1, 1)).days + 1) * _DAY_SECONDS * 1000)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update(tuple(initialState[name] for name in _STATE.names))
        self._clear_after(key[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        def out(seen: dict[str, np.ndarray], places, kinds, before, event_time) -> Row:
            cells = {name: seen[name][places] for name in _ARRAYS if name in seen}
            texts = {"kind": np.array(kinds, dtype=object), "prev_station_id": np.array(before, dtype=object)}
            return Row(**cells, **texts, event_time=event_time)

        if key[1] < 0:  # sightings that were not accepted
            for row in rows:
                seen = _unpacked([row.pack])
                reasons = seen["reason"]
                yield out(seen, slice(None), reasons, [None] * len(reasons), row.event_time)
            return
        packs, newest = [], {}
        for row in rows:
            packs.append(row.pack)
            hour = row.newest_s // _HOUR_SECONDS
            newest[hour] = max(newest.get(hour, row.event_time), row.event_time)
        stored = self.state.get()
        devices = {} if stored is None else {dev: tuple(entry) for dev, *entry in zip(*stored)}
        if stored is None:
            self._clear_after(key[0])
        seen = _unpacked(packs)
        places, kinds, before = self._count(seen, devices)
        if not places:
            return
        # In order of time, so that an hour's sightings are next to each other.
        hours = seen["event_s"][places] // _HOUR_SECONDS
        start = 0
        for hour, count in Counter(hours.tolist()).items():
            part = slice(start, start + count)
            yield out(seen, places[part], kinds[part], before[part], newest[hour])
            start += count
        lasts, stations = zip(*devices.values())
        self.state.update((list(devices), list(lasts), list(stations)))

    def _count(self, seen: dict[str, np.ndarray], devices: dict) -> tuple[list[int], list[str], list[str | None]]:
        """Places of the counted rows in order of time, their kinds and stations before; updates the devices."""
        places, kinds, before = [], [], []
        dev_ids, station_ids, seconds, seqs = (seen[name].tolist() for name in ("dev_id", "station_id", "event_s", "seq"))
        for second, _, place in sorted(zip(seconds, seqs, range(len(seqs)))):
            dev, here = dev_ids[place], station_ids[place]
            last, station = devices.get(dev, (None, None))
            if station is None:
                kind = "first"
            elif here != station:
                kind = "move"
            elif second > last + self.gap:
                kind = "revisit"
            else:
                continue
            places.append(place)
            kinds.append(kind)
            before.append(station)
            devices[dev] = (second, here)
        return places, kinds, before

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def epoch_seconds(ts: Column) -> Column:
    """Wall-clock seconds of a zone-less timestamp since 1970, as if it were UTC.

    Taken from its parts, because any way through ``timestamp`` asks for the session zone.
    """
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * _DAY_SECONDS + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def from_epoch_seconds(seconds: Column) -> Column:
    """The zone-less timestamp again."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def _bucket(column: str) -> Column:
    return F.pmod(F.hash(column), F.lit(BUCKETS))


def count_visits_stream(
    sightings: DataFrame,
    gap_minutes: int = GAP_MINUTES,
    today: Column | None = None,
    prior: DataFrame | None = None,
) -> DataFrame:
    """Counted and set-aside sightings of a stream, in append mode.

    ``kind`` is first, revisit or move for a visit, late or future for a sighting that is not
    accepted on ``today``; without ``today``, all are accepted. ``visits_of`` and ``set_aside`` part
    the two, and ``streaming.metrics`` has their counts per batch. ``prior`` is device state to begin with, used by the query's first batch.
    ``event_time``, by which the watermark goes, is that of a sighting's pack: right to the hour.

    The state store must be RocksDB; a session that names another one gets it set here.
    """
    sightings.sparkSession.conf.set(_PROVIDER, _ROCKSDB)
    # The counter travels with the query, so that workers need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    if today is None:
        seen = sightings.withColumns({"reason": F.lit(None).cast("string"), "judged_on": F.lit(None).cast("date")})
    else:
        seen = observe_judged(judged(sightings, today)).withColumn("judged_on", today)
    day_s = F.datediff("judged_on", F.lit("1970-01-01").cast("date")).cast("long") * _DAY_SECONDS
    aside = F.col("reason").isNotNull()
    keyed = (
        seen.withColumn("event_s", epoch_seconds(F.col("event_ts")))
        .withColumn("time_s", F.when(aside, day_s).otherwise(F.col("event_s")))
        .withColumn("judged_day", F.unix_date("judged_on"))
        .withColumn("bucket", F.when(aside, -1 - _bucket("seq")).otherwise(_bucket("dev_id")))
        .select(*_KEY, "time_s", *_PACK.names)
        .mapInArrow(_packed, _PACKED)
        .withColumn("event_time", F.timestamp_seconds("newest_s"))
        .withWatermark("event_time", WATERMARK)
    )
    state = None
    if prior is not None:
        rows = prior.select(
            F.col("start_date").alias("event_date"), _bucket("dev_id").alias("bucket"),
            F.struct("dev_id", epoch_seconds(F.col("last_datetime")).alias("last_s"), "station_id").alias("entry"),
        )
        # One row per key, as a key's state is set as a whole.
        buckets = rows.groupBy(*_KEY).agg(F.collect_list("entry").alias("entries"))
        state = buckets.select(*_KEY, *[F.col(f"entries.{name}") for name in _STATE.names]).groupBy(*_KEY)
    found = keyed.groupBy(*_KEY).transformWithState(
        VisitCounter(gap_minutes),
        outputStructType=_OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
        initialState=state,
        eventTimeColumnName="event_time",
    )
    rows = found.select("event_time", F.inline(F.arrays_zip(*_ARRAYS)))
    timed = rows.withColumn("event_ts", from_epoch_seconds(F.col("event_s")))
    dated = timed.withColumns(
        {
            "stat_date": F.to_date("event_ts"),
            "hour": hour_of(F.col("event_ts")),
            "judged_on": F.date_from_unix_date("judged_day"),
        }
    )
    return dated.select(*VISIT_FACT.names, "sensor_id", "judged_on", "event_time")


def visits_of(rows: DataFrame) -> DataFrame:
    """The visit facts among the rows of ``count_visits_stream``."""
    return rows.where(F.col("kind").isin(VISIT_KINDS)).select(*VISIT_FACT.names)


def set_aside(rows: DataFrame) -> DataFrame:
    """The sightings among them that were not accepted, with the reason."""
    other = rows.where(F.col("kind").isin(REASONS)).withColumnsRenamed({"stat_date": "event_date", "kind": "reason"})
    return other.select(*SIGHTING.names, "reason")


def stored_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Device state as a stream's checkpoint has it after its last batch, or after a given one."""
    spark.conf.set(_PROVIDER, _ROCKSDB)
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last_counted")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    entries = F.arrays_zip(*[F.col(f"value.{name}") for name in _STATE.names])
    rows = reader.load().select(F.col("key.event_date").alias("start_date"), F.inline(entries))
    last = from_epoch_seconds(F.col("last_s")).alias("last_datetime")
    return rows.select("dev_id", "start_date", last, "station_id").select(*DEVICE_STATE.names)


def hourly_stream(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Visits per station, or flows per station pair, of each hour that the watermark has passed."""
    if keys == FLOW_KEY:
        facts = rows.where(F.col("kind") == "move")
        facts = facts.withColumnsRenamed({"prev_station_id": FLOW_KEY[0], "station_id": FLOW_KEY[1]})
    else:
        facts = rows.where(F.col("kind").isin(VISIT_KINDS))
    hours = facts.groupBy(F.window("event_time", "1 hour").alias("hour"), *keys).count()
    start = from_epoch_seconds(F.unix_timestamp("hour.start"))
    return hours.select(*keys, F.to_date(start).alias("stat_date"), hour_of(start).alias("hour"), "count")


def _state_partitions(spark: SparkSession) -> int:
    """The cluster's cores; no more than the session shuffles into."""
    return min(int(spark.conf.get(_PARTITIONS)), spark.sparkContext.defaultParallelism)


def write_facts(
    facts: DataFrame,
    path: str,
    checkpoint: str,
    by: str | list[str] = "stat_date",
    partitions: int | None = None,
    **trigger,
):
    """Append rows of a stream to a parquet table, exactly once, by day (or other columns).

    ``partitions`` of the state follow the cluster's cores where none are given. A checkpoint keeps the
    number it began with.
    """
    spark = facts.sparkSession
    writer = (
        facts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(by)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
    )
    shuffles = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, partitions or _state_partitions(spark))
    try:
        return writer.start()  # the stream has a copy of the session's settings from here on
    finally:
        spark.conf.set(_PARTITIONS, shuffles)


def write_judged(rows: DataFrame, path: str, checkpoint: str, **trigger):
    """Append all rows of ``count_visits_stream`` to one table: visits by event day, others by judged day."""
    visit = F.col("kind").isin(VISIT_KINDS)
    placed = rows.drop("event_time").withColumns(
        {"counted": visit, "day": F.when(visit, F.col("stat_date")).otherwise(F.col("judged_on"))}
    )
    return write_facts(placed, path, checkpoint, ["counted", "day"], **trigger)


def read_judged(spark: SparkSession, path: str, counted: bool) -> DataFrame:
    """The visits of a table of ``write_judged``, or the sightings it has set aside."""
    more = "sensor_id string, judged_on date, counted boolean, day date"
    schema = T.StructType([*VISIT_FACT.fields, *T.StructType.fromDDL(more).fields])
    rows = spark.read.schema(schema).parquet(path).where(F.col("counted") == counted)
    return visits_of(rows) if counted else set_aside(rows)
