"""A song table made from ``lineitem`` and ``part``: grouped averages, winners, counts, histogram.

genre = part type, year = ship year, popularity = quantity, artist = supplier, track = part,
duration in milliseconds = price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.operators import tables
from brambling.plans.tables import read
from brambling.session import scratch_path
from brambling.sources.tables import read_csv

POPULAR = 40


def plays(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("track_id"),
        F.col("l_suppkey").alias("artist_name"),
        F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("popularity"),
        (F.col("l_extendedprice") / 60000).alias("duration_minutes"),
    )


def genres(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(F.col("p_partkey").alias("track_id"), F.col("p_type").alias("genre"))


def read_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "part")
    read(spark, folder, "part").write.csv(path, header=True)
    return read_csv(spark, path)


def drop_any_null(spark: SparkSession, folder: str) -> DataFrame:
    items = read(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.when(F.col("l_tax") == 0.03, float("nan")).otherwise(F.col("l_tax")).alias("l_tax"),
    )
    return tables.drop_any_null(items)


def cast_numeric(spark: SparkSession, folder: str) -> DataFrame:
    raw = read(spark, folder, "lineitem").select(
        F.monotonically_increasing_id().alias("_c0"),
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_quantity").cast("string")).alias("popularity"),
        F.col("l_discount").cast("string").alias("energy"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy")).otherwise("?").alias("year"),
    )
    numeric = tables.cast_columns(raw.drop("_c0"), {"popularity": "double", "energy": "double"})
    return tables.drop_any_null(tables.cast_columns(numeric, {"popularity": "int", "year": "int"}))


def genre_popularity(spark: SparkSession, folder: str) -> DataFrame:
    return tables.average_by_joined(
        plays(spark, folder), genres(spark, folder), "track_id", ["genre", "year"], "popularity", "average_popularity"
    )


def avg_by_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    return genre_popularity(spark, folder).withColumn("average_popularity", F.round("average_popularity", 6))


def avg_by_one_table(spark: SparkSession, folder: str) -> DataFrame:
    average = tables.average_by(plays(spark, folder), ["artist_name", "year"], "popularity", "average_popularity")
    return average.withColumn("average_popularity", F.round("average_popularity", 6))


def top_group_per_partition(spark: SparkSession, folder: str) -> DataFrame:
    return tables.top_of_each(avg_by_two_keys(spark, folder), "year", "average_popularity")


def artist_track_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = tables.count_by(plays(spark, folder), "artist_name", "track_id", "num_tracks")
    return tables.most_counted(counts, "artist_name", "num_tracks")


def duration_histogram(spark: SparkSession, folder: str) -> DataFrame:
    table = tables.histogram(plays(spark, folder), "duration_minutes", 20)
    return table.select("bucket", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


def avg_over_threshold(spark: SparkSession, folder: str) -> DataFrame:
    popular = F.col("popularity") >= POPULAR
    average = tables.average_over(plays(spark, folder), F.col("duration_minutes"), popular, "average_duration")
    return average.select(F.round("average_duration", 6).alias("average_duration"))


QUERIES = {
    f.__name__: f
    for f in (
        read_csv_inferred,
        drop_any_null,
        cast_numeric,
        avg_by_two_keys,
        avg_by_one_table,
        top_group_per_partition,
        artist_track_counts,
        duration_histogram,
        avg_over_threshold,
    )
}


def oracles() -> dict[str, str]:
    averages = (
        "SELECT p_type AS genre, year(l_shipdate)::INTEGER AS year, avg(l_quantity) AS a"
        " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"
    )
    return {
        "read_csv_inferred": "SELECT p_partkey::INTEGER AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
        "drop_any_null": (
            "SELECT l_orderkey, l_linenumber, l_returnflag, l_tax FROM lineitem"
            " WHERE l_returnflag <> 'R' AND l_tax <> 0.03"
        ),
        "cast_numeric": (
            "SELECT l_orderkey, l_linenumber, l_quantity::INTEGER AS popularity, l_discount AS energy,"
            " year(l_shipdate)::INTEGER AS year FROM lineitem WHERE l_returnflag <> 'N' AND l_linestatus = 'F'"
        ),
        "avg_by_two_keys": f"SELECT genre, year, round(a, 6) AS average_popularity FROM ({averages})",
        "avg_by_one_table": (
            "SELECT l_suppkey AS artist_name, year(l_shipdate)::INTEGER AS year,"
            " round(avg(l_quantity), 6) AS average_popularity FROM lineitem GROUP BY ALL"
        ),
        "top_group_per_partition": (
            "SELECT genre, year, a AS average_popularity, r::INTEGER AS rank FROM (SELECT genre, year, a,"
            f" rank() OVER (PARTITION BY year ORDER BY a DESC) AS r FROM (SELECT genre, year, round(a, 6) AS a FROM ({averages}))) WHERE r = 1"
        ),
        "artist_track_counts": (
            "SELECT l_suppkey AS artist_name, count(l_partkey) AS num_tracks FROM lineitem"
            " GROUP BY ALL ORDER BY num_tracks DESC, artist_name LIMIT 20"
        ),
        "duration_histogram": (
            "WITH v AS (SELECT l_extendedprice / 60000 AS x FROM lineitem),"
            " m AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 20 AS w FROM v),"
            " c AS (SELECT least(floor((x - lo) / w), 19)::INTEGER AS bucket, count(*) AS n FROM v, m GROUP BY ALL)"
            " SELECT i::INTEGER AS bucket, round(lo + i * w, 6) AS lo,"
            " round(CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * w END, 6) AS hi, coalesce(n, 0) AS n"
            " FROM m, range(20) t(i) LEFT JOIN c ON bucket = i"
        ),
        "avg_over_threshold": (
            "SELECT round(avg(l_extendedprice / 60000), 6) AS average_duration FROM lineitem"
            f" WHERE l_quantity >= {POPULAR}"
        ),
    }
