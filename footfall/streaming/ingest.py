"""Messages to facts, state and hourly counts, one micro-batch at a time.

Each micro-batch is counted by the batch operator, so hot device-days are split over tasks and
nothing runs in Python. A micro-batch writes whole folders of its own, ``open/batch_id=N`` of each
table, also when they are empty; run again after a failure it replaces them. The day by which
rows are late or future is fixed in the first run of a batch and read in later ones.

Device state is a log of the device-days each batch changed. A batch reads the state of the days
it touches only, and keeps of it the device-days it touches, before anything is grouped.

Every ``close_every`` batches the finished batches before the current one are closed: facts, side
tables and counts go to one folder ``closed/through=N``, state to a snapshot without expired days, and
their open folders are deleted. A batch opens the last snapshot and at most the open folders since,
never a folder of all batches.

Closed folders are merged upward, as a log-structured tree is: ``merge_every`` of them become one
folder ``level-1/through=N``, as many of those one of ``level-2``, and so on. Hourly counts are added
up in each merge, so a key and day has one row per folder. A row is written again once per level,
and after B batches a table has fewer than ``close_every + merge_every * log(B)`` folders to open.
Readers take of each level only the folders beyond the last finished one of the level above, so a
loss at any point, also between writing a merged folder and deleting what went into it, shows no
row twice and hides none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.times import local_day
from footfall.operators.decode import decode_sighting, project_sighting, quarantine_bad
from footfall.operators.horizon import filter_horizon, future_drop, late_drop
from footfall.operators.sinks import replace_whole
from footfall.operators.staging import staged
from footfall.operators.state import device_state, expire_state
from footfall.operators.stats import flows_hourly, station_hourly, widen
from footfall.operators.visits import count_visits, flows_from_visits
from footfall.schemas import (
    DEVICE_STATE,
    FLOW_KEY,
    HOUR_COLUMNS,
    MESSAGE,
    SIGHTING,
    STATION_KEY,
    VISIT_FACT,
    hourly_wide,
)
from footfall.sources import folders

_FACTS = {
    "visits": VISIT_FACT,
    "station_hourly": hourly_wide(STATION_KEY),
    "flows_hourly": hourly_wide(FLOW_KEY),
    "dropped": T.StructType([*SIGHTING.fields, T.StructField("reason", T.StringType())]),
    "rejected": T.StructType([*MESSAGE.fields, T.StructField("problem", T.StringType())]),
}
#: Tables without days have their folders unpartitioned.
_BY = {name: ["stat_date"] for name in ("visits", "station_hourly", "flows_hourly")}
_KEYS = {"station_hourly": STATION_KEY, "flows_hourly": FLOW_KEY}


@dataclass(frozen=True)
class Ingest:
    """Where the tables are, which day is today, and how often batches are closed.

    With ``tz_delta_hours`` a stream's rows are judged by the local day of their micro-batch's own
    time, which the stream's offset log keeps. ``today`` gives the day instead, for rows that come
    from elsewhere. With neither, every day is accepted.
    """

    root: str
    today: Callable[[], dt.date] | None = None
    tz_delta_hours: int | None = None
    close_every: int = 50
    merge_every: int = 8

    def table(self, name: str) -> str:
        """Path of one table."""
        return f"{self.root}/{name}"

    def _open(self, name: str, batch_id: int) -> str:
        return f"{self.table(name)}/open/batch_id={batch_id}"

    def _day(self, messages: DataFrame, batch_id: int) -> dt.date | None:
        """The day of a batch: the one its first run has written down."""
        spark, path = messages.sparkSession, f"{self.table('days')}/batch_id={batch_id}"
        if folders.finished(spark, path):
            return spark.read.schema("day date").parquet(path).first()[0]
        if self.today is not None:
            day = self.today()
        elif self.tz_delta_hours is not None and "batch_time" in messages.columns:
            first = messages.select(F.unix_timestamp("batch_time")).first()
            if first is None:
                return None
            moment = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=first[0])
            day = local_day(moment, self.tz_delta_hours)
        else:
            return None
        replace_whole(spark.createDataFrame([(day,)], "day date"), path)
        return day

    def _read(self, spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
        """Rows of some folders ``kind/number=N``; no others are listed, and those of a kind are one scan."""
        kinds: dict[str, list[str]] = {}
        for path in paths:
            kinds.setdefault(path.rsplit("/", 1)[0], []).append(path)
        scans = [spark.read.schema(schema).option("basePath", kind).parquet(*own) for kind, own in kinds.items()]
        rows = [scan.select(*schema.names) for scan in scans]
        return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], schema)

    def state(self, spark: SparkSession, batch_id: int, touched: DataFrame | None = None) -> DataFrame:
        """State before a batch: the last snapshot and the changes logged since.

        ``touched`` (dev_id, start_date) keeps only those device-days: its days prune the
        folders' partitions, and the rows are filtered by a semi join before they are grouped.
        """
        snapshots = self.table("device_state") + "/snapshot"
        known = [n for n in folders.numbers(spark, snapshots) if n < batch_id]
        last = known[-1] if known else -1
        paths = [f"{snapshots}/batch_id={last}"] if known else []
        paths += [self._open("device_state", n) for n in range(last + 1, batch_id)]
        paths = [path for path in paths if folders.exists(spark, path)]
        days = None if touched is None else [r[0] for r in touched.select("start_date").distinct().collect()]
        log = spark.createDataFrame([], T.StructType([*DEVICE_STATE.fields, T.StructField("place", T.IntegerType())]))
        for place, path in enumerate(paths):
            rows = spark.read.schema(DEVICE_STATE).parquet(path)
            rows = rows if days is None else rows.where(F.col("start_date").isin(days))
            log = log.unionByName(rows.withColumn("place", F.lit(place)))
        if touched is not None:
            log = log.join(touched, ["dev_id", "start_date"], "left_semi")
        newest = F.max_by(F.struct("last_datetime", "station_id"), "place").alias("row")
        return log.groupBy("dev_id", "start_date").agg(newest).select("dev_id", "start_date", "row.*")

    def run_batch(self, messages: DataFrame, batch_id: int) -> None:
        """Count one micro-batch of (seq, value) messages."""
        spark = messages.sparkSession
        today = self._day(messages, batch_id)
        decoded = staged(decode_sighting(messages.select("seq", "value")), "decoded")
        replace_whole(quarantine_bad(decoded), self._open("rejected", batch_id))
        sightings = project_sighting(decoded)
        if today is not None:
            dropped = late_drop(sightings, today).unionByName(future_drop(sightings, today))
            replace_whole(dropped, self._open("dropped", batch_id))
            sightings = filter_horizon(sightings, today)

        touched = sightings.select("dev_id", F.col("event_date").alias("start_date")).distinct()
        prior = self.state(spark, batch_id, staged(touched, "touched"))
        replace_whole(count_visits(sightings, prior), self._open("visits", batch_id), ["stat_date"])
        visits = self._read(spark, VISIT_FACT, [self._open("visits", batch_id)])
        stations = widen(station_hourly(visits), STATION_KEY)
        flows = widen(flows_hourly(flows_from_visits(visits)), FLOW_KEY)
        replace_whole(stations, self._open("station_hourly", batch_id), ["stat_date"])
        replace_whole(flows, self._open("flows_hourly", batch_id), ["stat_date"])
        replace_whole(device_state(visits), self._open("device_state", batch_id), ["start_date"])
        if batch_id and batch_id % self.close_every == 0:
            self.close(spark, batch_id - 1, today)

    def close(self, spark: SparkSession, through: int, today: dt.date | None = None) -> None:
        """Gather the batches up to ``through``, which are all finished, and delete their folders."""
        for name in _FACTS:
            self._gather(spark, name, self._paths(spark, name, through)["open"], f"closed/through={through}")
            self._merge(spark, name)
        snapshots = self.table("device_state") + "/snapshot"
        target = f"{snapshots}/batch_id={through}"
        if not folders.finished(spark, target):
            state = self.state(spark, through + 1)
            replace_whole(state if today is None else expire_state(state, today), target, ["start_date"])
        for name in [*_FACTS, "device_state"]:
            for batch in folders.numbers(spark, f"{self.table(name)}/open"):
                if batch <= through:
                    folders.remove(spark, self._open(name, batch))
        for batch in folders.numbers(spark, snapshots):
            if batch < through:
                folders.remove(spark, f"{snapshots}/batch_id={batch}")
        for batch in folders.numbers(spark, self.table("days")):
            if batch <= through:  # a finished batch is not judged again
                folders.remove(spark, f"{self.table('days')}/batch_id={batch}")

    def _gather(self, spark: SparkSession, name: str, paths: list[str], folder: str) -> None:
        """The rows of some folders as one folder, unless that is finished already."""
        target = f"{self.table(name)}/{folder}"
        if not folders.finished(spark, target):
            rows = self._read(spark, _FACTS[name], paths)
            replace_whole(self._added(rows, _KEYS[name]) if name in _KEYS else rows, target, _BY.get(name))

    def _merge(self, spark: SparkSession, name: str) -> None:
        """Merge the folders of each level that has enough of them, from the lowest up."""
        found = [k for k in folders.children(spark, self.table(name)) if k.startswith("level-")]
        highest = max((int(k.split("-")[1]) for k in found), default=0)
        known = [folders.numbers(spark, f"{self.table(name)}/{self._kind(n)}") for n in range(highest + 1)]
        for level in range(highest + 2):
            if level == len(known):
                return
            through = max((n for above in known[level + 1 :] for n in above), default=-1)
            kind, above = self._kind(level), self._kind(level + 1)
            for n in known[level]:
                if n <= through:  # merged before a loss, not yet deleted
                    folders.remove(spark, f"{self.table(name)}/{kind}/through={n}")
            beyond = [n for n in known[level] if n > through]
            if len(beyond) >= self.merge_every:
                paths = [f"{self.table(name)}/{kind}/through={n}" for n in beyond]
                self._gather(spark, name, paths, f"{above}/through={beyond[-1]}")
                for path in paths:
                    folders.remove(spark, path)
                known += [[]] if level + 1 == len(known) else []
                known[level + 1].append(beyond[-1])

    @staticmethod
    def _kind(level: int) -> str:
        return f"level-{level}" if level else "closed"

    def start(self, messages: DataFrame, checkpoint: str, **trigger):
        """Run on a message stream; the trigger defaults to every three seconds."""
        if self.tz_delta_hours is not None:
            messages = messages.withColumn("batch_time", F.current_timestamp())
        return (
            messages.writeStream.foreachBatch(self.run_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "3 seconds"}))
            .start()
        )

    def _paths(self, spark: SparkSession, name: str, through: int | None = None) -> dict[str, list[str]]:
        """The folders to read of each kind, from the highest level to the open ones."""
        kinds = [k for k in folders.children(spark, self.table(name)) if k.startswith("level-")]
        kinds = sorted(kinds, key=lambda k: -int(k.split("-")[1])) + ["closed", "open"]
        found, last = {}, -1
        for kind in kinds:
            known = [n for n in folders.numbers(spark, f"{self.table(name)}/{kind}") if n > last]
            if kind == "open":
                known = [n for n in known if through is None or n <= through]
            label = "batch_id" if kind == "open" else "through"
            found[kind] = [f"{self.table(name)}/{kind}/{label}={n}" for n in known]
            last = max([last, *known])
        return found

    def _rows(self, spark: SparkSession, name: str) -> DataFrame:
        return self._read(spark, _FACTS[name], sum(self._paths(spark, name).values(), []))

    @staticmethod
    def _added(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys, "stat_date").agg(*[F.sum(c).alias(c) for c in HOUR_COLUMNS])

    def visits(self, spark: SparkSession) -> DataFrame:
        """Visit facts written so far."""
        return self._rows(spark, "visits")

    def dropped(self, spark: SparkSession) -> DataFrame:
        """Late and future sightings, with the reason."""
        return self._rows(spark, "dropped")

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Text and problem of the rejected messages."""
        return self._rows(spark, "rejected")

    def hourly(self, spark: SparkSession, name: str) -> DataFrame:
        """Hourly counts: one row per key and day of each folder, added up."""
        return self._added(self._rows(spark, name), _KEYS[name])
