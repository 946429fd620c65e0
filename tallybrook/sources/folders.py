"""Listing and removing folders of a lake, on whichever file system they are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    system, folder = _opened(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove files or folders; those that are gone already are no error."""
    for path in paths:
        system, found = _opened(spark, path)
        system.delete(found, True)
