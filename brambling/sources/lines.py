"""Delimited text lines: reading, writing and splitting into named fields."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a trip line, in file order.
TRIP_FIELDS = (
    "medallion",
    "hack_license",
    "vendor_id",
    "pickup_datetime",
    "payment_type",
    "fare_amount",
    "surcharge",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files (a path, URI or glob) as one ``value`` column, one row per line."""
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.text(path)


def split_line(line: Column | str = "value", separator: str = ",") -> Column:
    """All fields of a line; there is no quoting, and empty fields at the end are kept."""
    return F.split(line, re.escape(separator), -1)


def with_fields(lines: DataFrame, names: tuple[str, ...] = TRIP_FIELDS, separator: str = ",") -> DataFrame:
    """Lines as string columns; fields missing from a short line are null."""
    split = lines.select(split_line("value", separator).alias("f"))
    return split.select(*[F.get("f", i).alias(name) for i, name in enumerate(names)])
