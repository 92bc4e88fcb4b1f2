"""The operators applied to the given tables, each with an equivalent SQL text for checking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brambling.plans import classification, logistic, neighbours, regression, songs, texts, trips

Query = Callable[[SparkSession, str], DataFrame]
_PARTS = (trips, songs, texts, neighbours, logistic, regression, classification)


def queries() -> dict[str, Query]:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.oracles().items()}
