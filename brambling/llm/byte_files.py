"""Binary files on any file system that Spark reaches, written by Spark's own committer.

Each row of a one-column table is a run of bytes; a partition is one file. The text writer ends each
row with a separator, for which an empty skippable Zstandard frame is taken: Zstandard readers pass
over it, and other formats count its length. A task that is repeated after a loss writes its file
anew, and only the committed one stays.
"""

from __future__ import annotations

import struct
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Magic number 0x184D2A50 and size 0, all of them ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)


def write_bytes(rows: DataFrame, path: str, most: int = 0) -> None:
    """Write the only column of ``rows``, a binary one, a file per partition or per ``most`` rows of one."""
    value = F.col(rows.columns[0]).cast("string").alias("value")
    rows.select(value).write.option("lineSep", SEPARATOR.decode("ascii")).option("maxRecordsPerFile", most).text(path)


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``(content)`` per file that is not empty."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def contents(batch: Any) -> list[memoryview]:
    """The files of an Arrow batch of ``read_bytes``, without copies."""
    return [memoryview(x.as_buffer()) for x in batch.column(0)]
