"""Operators on typed tables: casts, grouped averages, winners per group, counts, histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brambling.session import store


def drop_any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null or NaN in any of ``columns`` (default: all)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit its type becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def average_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def average_by_joined(
    facts: DataFrame, dimension: DataFrame, on: str, keys: Sequence[str], value: str, name: str
) -> DataFrame:
    """``average_by`` over ``facts`` joined with ``dimension``.

    The facts are summed per join key first: a key that owns a third of the facts reaches the join
    as a handful of rows. A group without a value has a null average.
    """
    own_keys = [k for k in keys if k in facts.columns]
    partial = facts.groupBy(on, *own_keys).agg(
        F.sum(F.col(value).cast("double")).alias("_sum"), F.count(value).alias("_n")
    )
    average = F.try_divide(F.sum("_sum"), F.sum("_n"))
    return partial.join(dimension, on).groupBy(*keys).agg(average.alias(name))


def top_of_each(df: DataFrame, group: str, value: str, rank: str = "rank") -> DataFrame:
    """The rows with the largest ``value`` of each ``group``, ties included.

    Round averages before, so that the order in which a sum was taken cannot part a tie.
    """
    order = Window.partitionBy(group).orderBy(F.desc(value))
    return df.withColumn(rank, F.rank().over(order)).where(F.col(rank) == 1)


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with the 0-based place of each row under ``order``, which should leave no ties.

    Ranges of rows are numbered by the tasks that hold them; a table of one row per task tells how
    many rows the ranges before have. No task sees all rows.
    """
    task = "_task"
    dealt = store(df.repartitionByRange(*order).withColumn(task, F.spark_partition_id()))
    earlier = Window.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(task).agg(F.count("*").alias("_n"))
    begins = sizes.select(task, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    place = F.row_number().over(Window.partitionBy(task).orderBy(*order)) - 1 + F.col("_begin")
    return dealt.join(F.broadcast(begins), task).withColumn(name, place).drop(task, "_begin")


def count_by(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """How often ``counted`` is not null, per ``key``."""
    return df.groupBy(key).agg(F.count(counted).alias(name))


def most_counted(counts: DataFrame, key: str, name: str, k: int = 20) -> DataFrame:
    return counts.orderBy(F.desc(name), key).limit(k)


def average_over(df: DataFrame, value: Column, condition: Column, name: str) -> DataFrame:
    """One row: the average of ``value`` where ``condition`` holds; null if it never does."""
    return df.where(condition).agg(F.avg(value).alias(name))


def histogram(df: DataFrame, column: str, buckets: int = 20) -> DataFrame:
    """``(bucket, lo, hi, n)`` for equally wide buckets between the smallest and the largest value.

    The last bucket includes its upper edge, empty buckets count 0, and a column with one distinct
    value has one bucket. Nulls, NaN and infinities are not counted.
    """
    finite = F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf"))
    values = df.select(F.col(column).cast("double").alias("v")).where(finite)
    low, high = values.agg(F.min("v"), F.max("v")).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bucket int, lo double, hi double, n bigint")
    if low == high:
        buckets = 1
    width = (high - low) / buckets or 1.0
    bucket = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(buckets - 1)).cast("int")
    counts = values.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    number = F.col("id").cast("int")
    edges = spark.range(buckets).select(
        number.alias("bucket"),
        (F.lit(low) + number * F.lit(width)).alias("lo"),
        F.when(number == buckets - 1, F.lit(high)).otherwise(F.lit(low) + (number + 1) * F.lit(width)).alias("hi"),
    )
    return edges.join(counts, "bucket", "left").select(
        "bucket", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n")
    )


def key_split(df: DataFrame, key: str, share: float = 0.8) -> Column:
    """True for the ``share`` of keys that a hash of the key puts into the training part.

    Unlike a random split it does not depend on how the rows are partitioned, so recomputing a lost
    partition cannot move a row from one part to the other. A null key is in the test part.
    """
    digest = F.conv(F.substring(F.md5(df[key].cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(digest < int(share * 2**32), F.lit(False))


def random_split(df: DataFrame, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test part of a scan or stored table.

    The choice depends on the partitions of ``df``; behind a join or aggregation these may differ
    from one run to the next, so ``store`` such a table first.
    """
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test
