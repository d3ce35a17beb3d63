"""The raw device log as a stream: decode, set bad rows aside, drop copies, append.

Nothing is ever too late for the log, so there is no watermark: a copy is known by the rows
stored for its own day. A micro-batch opens only the days it touches.

A micro-batch writes one folder, by day. Every ``close_every`` batches the finished ones are gathered
into a folder whose files are bucketed by the log's key, and such folders merge upward
(``streaming.levels``), so a day lies in some dozens of folders after any number of batches. The
comparison with gathered rows joins bucket by bucket and shuffles none of them; only the rows of the
open folders, at most ``close_every`` batches, are shuffled. Keys are unique in the log, so buckets
are even whatever one sensor or device sends.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.decode import decode_device_log, project_device_log, quarantine_bad
from footfall.operators.devicelog import LOG_KEY, new_log_rows
from footfall.operators.sinks import replace_whole
from footfall.operators.staging import staged
from footfall.schemas import DEVICE_LOG, LOG_FLUSH_SECONDS, MESSAGE
from footfall.sources import folders
from footfall.streaming.levels import Levels

_STORED = T.StructType([*DEVICE_LOG.fields, T.StructField("log_date", T.DateType())])
_REJECTED = T.StructType([*MESSAGE.fields, T.StructField("problem", T.StringType())])


def _read(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    """Rows of some folders ``kind/number=N``, one scan per kind."""
    kinds: dict[str, list[str]] = {}
    for path in paths:
        kinds.setdefault(path.rsplit("/", 1)[0], []).append(path)
    rows = spark.createDataFrame([], schema)
    for kind, own in kinds.items():
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", kind).parquet(*own).select(*schema.names))
    return rows


@dataclass(frozen=True)
class DeviceLog:
    """The log below ``root``: tables ``log`` and ``rejected``.

    ``buckets`` should follow the size of a day; the number that a log begins with stays.
    """

    root: str
    buckets: int = 64
    close_every: int = 50
    merge_every: int = 8

    @property
    def _log(self) -> Levels:
        return Levels(f"{self.root}/log", self.merge_every)

    @property
    def _rejected(self) -> Levels:
        return Levels(f"{self.root}/rejected", self.merge_every)

    def _buckets(self, spark: SparkSession) -> int:
        """The number of buckets, written down when the log's first folder is gathered."""
        known = folders.numbers(spark, f"{self.root}/buckets")
        if not known:
            replace_whole(spark.createDataFrame([], "n int"), f"{self.root}/buckets/n={self.buckets}")
        return known[0] if known else self.buckets

    def _gather(self, spark: SparkSession, paths: list[str], target: str) -> None:
        """Write the rows of some folders as one, bucketed by key: a file per day and bucket."""
        buckets, name = self._buckets(spark), f"footfall_log_{uuid.uuid4().hex}"
        folders.remove(spark, target)  # an unfinished one
        rows = _read(spark, _STORED, paths).repartition(buckets, *LOG_KEY)
        writer = rows.write.format("parquet").partitionBy("log_date").bucketBy(buckets, *LOG_KEY)
        # Only a table of the catalog can be bucketed; its files stay when it is dropped.
        try:
            writer.mode("overwrite").option("path", target).saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _gathered(self, spark: SparkSession, days: list, name: str) -> DataFrame:
        """A bucketed table ``name`` over the gathered files of some days; the caller drops it."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DEVICE_LOG.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, log_date DATE, folder STRING) USING parquet "
            f"PARTITIONED BY (log_date, folder) CLUSTERED BY ({', '.join(LOG_KEY)}) "
            f"INTO {self._buckets(spark)} BUCKETS LOCATION '{self.root}/buckets/none'"
        )
        for path in self._log.gathered(spark):
            for day in days:
                if folders.exists(spark, f"{path}/log_date={day}"):
                    folder = "/".join(path.rsplit("/", 2)[1:])
                    spark.sql(
                        f"ALTER TABLE {name} ADD PARTITION (log_date='{day}', folder='{folder}') "
                        f"LOCATION '{path}/log_date={day}'"
                    )
        return spark.table(name)

    def new_rows(self, rows: DataFrame, batch_id: int, name: str) -> DataFrame:
        """Deduplicated rows whose key no earlier batch has; ``name`` is for the table of gathered files."""
        spark = rows.sparkSession
        # As many as a batch names; days, not batches, are what is listed here.
        days = [r[0] for r in rows.select(F.to_date("TimeNow")).distinct().collect()]
        recent = _read(spark, _STORED, self._log.pending(spark, batch_id - 1)).where(F.col("log_date").isin(days))
        fresh = new_log_rows(rows, self._gathered(spark, days, name))
        return fresh.join(recent.select(*LOG_KEY), LOG_KEY, "left_anti").withColumn("log_date", F.to_date("TimeNow"))

    def run_batch(self, messages: DataFrame, batch_id: int) -> None:
        """Append the rows of one micro-batch whose key is new; a batch run again replaces its own."""
        spark = messages.sparkSession
        decoded = staged(decode_device_log(messages), "decoded")
        replace_whole(quarantine_bad(decoded).select(*_REJECTED.names), self._rejected.open(batch_id))
        name = f"footfall_log_{uuid.uuid4().hex}"
        try:
            fresh = self.new_rows(project_device_log(decoded), batch_id, name)
            replace_whole(fresh.select(*_STORED.names), self._log.open(batch_id), ["log_date"])
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if batch_id and batch_id % self.close_every == 0:
            self.close(spark, batch_id - 1)

    def close(self, spark: SparkSession, through: int) -> None:
        """Gather the batches up to ``through``, which are all finished."""
        self._log.close(spark, through, lambda paths, target: self._gather(spark, paths, target))
        self._rejected.close(
            spark, through, lambda paths, target: replace_whole(_read(spark, _REJECTED, paths), target)
        )

    def start(self, messages: DataFrame, checkpoint: str, **trigger):
        """Run on a message stream; the trigger defaults to every few seconds."""
        return (
            messages.writeStream.foreachBatch(self.run_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{LOG_FLUSH_SECONDS} seconds"}))
            .start()
        )

    def rows(self, spark: SparkSession) -> DataFrame:
        """The log written so far."""
        return _read(spark, _STORED, self._log.gathered(spark) + self._log.pending(spark)).select(*DEVICE_LOG.names)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Text and reason of the rejected messages."""
        return _read(spark, _REJECTED, self._rejected.gathered(spark) + self._rejected.pending(spark))
