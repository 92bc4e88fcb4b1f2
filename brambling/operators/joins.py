"""Joining a large table with a small one whose size has been checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a materialised table: text by its length, other values as 16 bytes each."""
    width = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        width += F.coalesce(F.octet_length(name), F.lit(0)) + 16 if kind == "string" else F.lit(16)
    return df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()


def join_small(large: DataFrame, small: DataFrame, on: str, small_bytes: int) -> DataFrame:
    """Inner join of ``large`` with ``small``, which has at most ``small_bytes``.

    Within ``BROADCAST_BYTES`` the small table goes to every task and ``large`` is not shuffled.
    Above it both are shuffled and merged; a key that owns much of ``large`` is left to Spark's skew
    join (``spark.sql.adaptive.skewJoin``), which cuts its partition by measured size.
    """
    if small_bytes <= BROADCAST_BYTES:
        return large.join(F.broadcast(small), on)
    return large.join(small.hint("shuffle_merge"), on)


def left_small(large: DataFrame, small: DataFrame, on: Column, small_bytes: int) -> DataFrame:
    """Left join by a condition, in the two ways of ``join_small``; the column names must differ."""
    return large.join(F.broadcast(small) if small_bytes <= BROADCAST_BYTES else small.hint("shuffle_merge"), on, "left")
