"""Fits that several queries share: done once per session and state of the tables, then loaded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from brambling.session import scratch_path

_PATHS: dict[tuple, str] = {}


def state(spark: SparkSession, folder: str, table: str) -> tuple[int, int]:
    """Bytes and time of change of a given table, so that a changed one is not taken for the old one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength(), system.getFileStatus(place).getModificationTime()


def once(spark: SparkSession, folder: str, table: str, name: str, write: Callable[[str], None]) -> str:
    """The path at which ``write`` has stored a fit on ``table``; it is called the first time only."""
    key = (spark.sparkContext.applicationId, folder, name, state(spark, folder, table))
    if key not in _PATHS:
        path = scratch_path(spark, name)
        write(path)
        _PATHS[key] = path
    return _PATHS[key]
