"""Typed tables from CSV, and the calendar dimension."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.sources.lines import read_lines, split_line


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header. Types are inferred in an extra pass unless ``schema`` names them."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)


def calendar(spark: SparkSession, first: int, last: int | None = None) -> DataFrame:
    """``(date, weekday)`` as strings for every day of the years ``first`` to ``last``."""
    start = datetime.date(first, 1, 1)
    end = datetime.date((last or first) + 1, 1, 1)
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range((end - start).days).select(
        F.date_format(day, "yyyy-MM-dd").alias("date"), F.date_format(day, "EEEE").alias("weekday")
    )


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """``(date, weekday)`` from comma-separated lines; a header line is a pair that matches no date."""
    fields = read_lines(spark, path).select(split_line().alias("f"))
    return fields.select(F.get("f", 0).alias("date"), F.get("f", 1).alias("weekday"))
