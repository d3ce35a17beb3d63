"""Tables written to the shared folder within a job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.session import scratch_path


def staged(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back; their lineage ends here."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
