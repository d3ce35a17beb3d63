"""Message sources: JSON text with an arrival number ``seq``.

The Kafka connector is not part of Spark itself, so the two Kafka readers only add the
connector's options; the file readers give the same columns and are what the tests run on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schemas import MESSAGE

# What a micro-batch takes in at most, unless the caller says otherwise.
MAX_OFFSETS, MAX_FILES = 1_000_000, 1000

# The Kafka partition goes above the offset so that seq stays unique across partitions.
OFFSET_BITS = 48


def from_kafka_rows(rows: DataFrame) -> DataFrame:
    """Kafka rows to (seq, value); order within a partition is the offset order."""
    seq = F.shiftleft(F.col("partition").cast("long"), OFFSET_BITS) + F.col("offset")
    return rows.select(seq.alias("seq"), F.col("value").cast("string").alias("value"))


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = MAX_OFFSETS,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to one topic. Offsets live in the query's checkpoint, not in the broker."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return from_kafka_rows(reader.options(**(options or {})).load())


def kafka_batch(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """Read a topic from its first to its last offset as a batch (for backfills)."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return from_kafka_rows(reader.options(**(options or {})).load())


def message_files(spark: SparkSession, path: str) -> DataFrame:
    """Messages landed as parquet files with the columns (seq, value)."""
    return spark.read.schema(MESSAGE).parquet(path)


def message_file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = MAX_FILES
) -> DataFrame:
    """The same folder read as a stream, file by file."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
