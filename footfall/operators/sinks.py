"""Writers of the stored tables.

A replaced partition is first written to the shared folder. That cuts the lineage to the table
that is about to change, and leaves the finished rows at hand if the second write is lost.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.grid import insert_missing
from footfall.operators.monthly import month_start, upsert
from footfall.operators.staging import staged
from footfall.operators.stats import add_hours
from footfall.schemas import LOG_FLUSH_ROWS, hourly_wide, monthly

#: Small row groups let a look-up skip more; whole scans read them one after another.
STATE_ROW_GROUP_BYTES = 16 << 20


def _writer(rows: DataFrame, by: list[str]):
    """A partitioned writer: a value with many rows is written by several tasks, values with few
    rows share one."""
    return rows.hint("rebalance", *by).write.partitionBy(*by)


def append_rows(rows: DataFrame, path: str, by: list[str]) -> None:
    """Add rows to a partitioned table."""
    _writer(rows, by).mode("append").parquet(path)


def replace_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that occur in ``rows`` and no others."""
    writer = _writer(rows, by).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def replace_whole(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replace a folder by ``rows``, also when there are none."""
    writer = _writer(rows, by) if by else rows.write
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or no rows if it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _values(rows: DataFrame, column: str) -> list:
    """The dates in a date column: as many as the calendar allows, so safe on the driver."""
    return [row[0] for row in rows.select(column).distinct().collect()]


def add_hourly(delta: DataFrame, path: str, keys: list[str], batch_id: int) -> None:
    """Add wide hourly counts to a stored table; new keys get their row.

    Batches must come in the order of their numbers. Every row of a day carries the number of the
    last batch that changed the day, so a batch that is run again, after a loss at any point,
    leaves alone the days that have it and adds to the others. Only the days in the delta are
    read (static partition pruning) and rewritten.
    """
    delta = staged(delta, "delta")
    schema = hourly_wide(keys).add("last_batch", T.LongType())
    table = read_or_empty(delta.sparkSession, path, schema)
    old = table.where(F.col("stat_date").isin(_values(delta, "stat_date")))
    done = old.where(F.col("last_batch") >= batch_id).select("stat_date").distinct()
    fresh = delta.join(done, "stat_date", "left_anti")
    days = fresh.select("stat_date").distinct()
    merged = add_hours(old.drop("last_batch").join(days, "stat_date", "left_semi"), fresh, keys)
    merged = staged(merged.withColumn("last_batch", F.lit(batch_id).cast("long")), "hourly")
    replace_partitions(merged, path, ["stat_date"])


def ensure_hourly(grid: DataFrame, path: str, keys: list[str], days: list[dt.date]) -> None:
    """Add zero rows for the grid keys a stored table lacks; running it again adds nothing."""
    table = read_or_empty(grid.sparkSession, path, hourly_wide(keys))
    missing = insert_missing(grid, table.where(F.col("stat_date").isin(days)), keys)
    append_rows(staged(missing, "grid"), path, ["stat_date"])


def save_monthly(new: DataFrame, path: str, keys: list[str], mode: str = "merge") -> None:
    """Upsert monthly totals; only the months in ``new`` are read and rewritten."""
    new = staged(new, "totals")
    schema = T.StructType([*monthly(keys).fields, T.StructField("stat_month", T.DateType())])
    dated = new.select(month_start(F.col("stat_date")).alias("stat_month"))
    stored = read_or_empty(new.sparkSession, path, schema)
    old = stored.where(F.col("stat_month").isin(_values(dated, "stat_month"))).drop("stat_month")
    result = staged(upsert(old, new, keys, mode), "monthly")
    result = result.withColumn("stat_month", month_start(F.col("stat_date")))
    replace_partitions(result, path, ["stat_month"])


def read_monthly(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """A stored monthly table."""
    return spark.read.parquet(path).select(*keys, "stat_date", "count")


def save_state(state: DataFrame, path: str) -> None:
    """Replace the state of the event dates that occur in ``state``.

    Rows are cut into ranges of (day, device) and sorted, with a Bloom filter per row group, so that
    the reader of some devices skips files, row groups and pages. A device has one row per day, so
    no range is large.
    """
    order = ["start_date", "dev_id"]
    rows = staged(state, "state").repartitionByRange(*order).sortWithinPartitions(*order)
    writer = rows.write.partitionBy("start_date").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("parquet.bloom.filter.enabled#dev_id", "true")
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.option("parquet.block.size", STATE_ROW_GROUP_BYTES).parquet(path)


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append rows to a database table in bulk inserts; the caller supplies the connection."""
    rows.write.option("batchsize", LOG_FLUSH_ROWS).jdbc(
        url, table, mode="append", properties=properties
    )
