"""Revenue per date, driver and weekday, and the lists of the smallest and largest.

Amounts are summed as decimals, so the result does not depend on the order of the rows; only a sum
that the decimal type cannot hold is the sum of doubles. Sums are combined before each shuffle, so a driver or date that owns most rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _revenue(trips: DataFrame, key: str) -> DataFrame:
    return trips.groupBy(key).agg(F.try_sum("amount").alias("exact"), F.sum(F.col("amount").cast("double")).alias("rough"))


def _total(exact: Column, rough: Column) -> Column:
    return F.coalesce(exact.cast("double"), rough).alias("revenue")


def revenue_by(trips: DataFrame, key: str) -> DataFrame:
    return _revenue(trips, key).select(key, _total(F.col("exact"), F.col("rough")))


def smallest(totals: DataFrame, key: str, k: int = 5) -> DataFrame:
    return totals.orderBy("revenue", key).limit(k)


def largest(totals: DataFrame, key: str, k: int = 5) -> DataFrame:
    return totals.orderBy(F.desc("revenue"), key).limit(k)


def revenue_by_weekday(trips: DataFrame, days: DataFrame) -> DataFrame:
    """Revenue per weekday, largest first. Trips on dates that ``days`` lacks do not count.

    Trips are summed per date first, so the join sees one row per date, whatever their number.
    """
    per_day = _revenue(trips, "date").join(days, "date")
    return (
        per_day.groupBy("weekday")
        # A date without an exact sum leaves its weekday without one.
        .agg(F.try_sum("exact").alias("exact"), F.count_if(F.col("exact").isNull()).alias("gaps"), F.sum("rough").alias("rough"))
        .select("weekday", _total(F.when(F.col("gaps") == 0, F.col("exact")), F.col("rough")))
        .orderBy(F.desc("revenue"), "weekday")
    )
