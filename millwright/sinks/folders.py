"""Partition folders on whatever file system Spark is configured with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _handle(spark, path)
    return fs.exists(location)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a completed write or at least one partition folder is there."""
    fs, location = _handle(spark, path)
    return fs.exists(location) and len(fs.listStatus(location)) > 0


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's outermost partition column, from folder names alone."""
    fs, location = _handle(spark, path)
    if not fs.exists(location):
        return []
    prefix = f"{column}="
    names = [status.getPath().getName() for status in fs.listStatus(location)]
    return sorted(name[len(prefix) :] for name in names if name.startswith(prefix))


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder to a name that is not taken, in one step."""
    fs, location = _handle(spark, path)
    if not fs.rename(location, _handle(spark, to)[1]):
        raise RuntimeError(f"{to} could not be made from {path}")


def make(spark: SparkSession, path: str) -> None:
    fs, location = _handle(spark, path)
    fs.mkdirs(location)


def touch(spark: SparkSession, path: str) -> None:
    """Creates an empty file; its name is all it says."""
    fs, location = _handle(spark, path)
    fs.create(location, True).close()


def names(spark: SparkSession, path: str) -> list[str]:
    fs, location = _handle(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(location)) if fs.exists(location) else []


def drop(spark: SparkSession, path: str) -> None:
    fs, location = _handle(spark, path)
    fs.delete(location, True)
