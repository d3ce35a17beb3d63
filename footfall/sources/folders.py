"""Folders of stored tables on any store that Spark can reach. Only names pass through here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder."""
    store, place = _located(spark, path)
    return store.exists(place)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    store, place = _located(spark, path)
    if not store.exists(place):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(place))


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers N of the finished folders ``name=N`` in a folder."""
    found = [name for name in children(spark, path) if "=" in name and finished(spark, f"{path}/{name}")]
    return sorted(int(name.split("=")[1]) for name in found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it, if it is there."""
    store, place = _located(spark, path)
    store.delete(place, True)


def stamp(spark: SparkSession, path: str, millis: int) -> None:
    """Give a file, or the files in a folder, a modification time, as if just landed then."""
    store, place = _located(spark, path)
    for status in store.listStatus(place):
        store.setTimes(status.getPath(), millis, -1)
