"""Folders of whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, place = _place(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(place)) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file; one of that name is replaced."""
    fs, place = _place(spark, path)
    _, target = _place(spark, to)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(place, target):
        raise OSError(f"{path} could not be renamed to {to}")


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Sets a file's time of change."""
    fs, place = _place(spark, path)
    fs.setTimes(place, millis, -1)
