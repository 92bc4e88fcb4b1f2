from __future__ import annotations

import math

from pyspark.sql import functions as F

from brambling.operators import joins, tables
from brambling.session import scratch_path
from brambling.sources.tables import read_csv


def values(spark, numbers):
    return spark.createDataFrame([(float(n) if n is not None else None,) for n in numbers], "v double")


def buckets(df):
    return [tuple(r) for r in df.orderBy("bucket").collect()]


def test_histogram_includes_the_maximum_and_empty_buckets(spark):
    df = values(spark, [1, 2, 3, 10, None, math.nan])
    assert buckets(tables.histogram(df, "v", 3)) == [(0, 1.0, 4.0, 3), (1, 4.0, 7.0, 0), (2, 7.0, 10.0, 1)]


def test_histogram_of_one_value(spark):
    assert buckets(tables.histogram(values(spark, [5, 5]), "v", 20)) == [(0, 5.0, 5.0, 2)]


def test_histogram_of_nothing(spark):
    assert buckets(tables.histogram(values(spark, [None]), "v", 20)) == []


def test_casts_turn_misfits_into_nulls(spark):
    df = spark.createDataFrame([("1.5", "7"), ("x", "2000"), ("3", "?")], "a string, b string")
    cast = tables.cast_columns(df, {"a": "double", "b": "int"})
    assert [tuple(r) for r in cast.collect()] == [(1.5, 7), (None, 2000), (3.0, None)]
    assert [tuple(r) for r in tables.drop_any_null(cast).collect()] == [(1.5, 7)]


def test_drop_any_null_drops_nan(spark):
    assert tables.drop_any_null(values(spark, [1, None, math.nan])).count() == 1


def test_winners_keep_ties(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 2.0), ("c", 1, 1.0), ("a", 2, 0.5)], "g string, y int, v double")
    best = tables.top_of_each(df, "y", "v")
    assert sorted((r.y, r.g) for r in best.collect()) == [(1, "a"), (1, "b"), (2, "a")]


def test_counts_skip_nulls_and_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "2"), ("c", None)], "artist string, track string")
    counts = tables.count_by(df, "artist", "track", "n")
    assert [tuple(r) for r in tables.most_counted(counts, "artist", "n", 2).collect()] == [("a", 1), ("b", 1)]


def test_average_over_nothing_is_null(spark):
    assert tables.average_over(values(spark, [1]), F.col("v"), F.col("v") > 5, "a").first()[0] is None


def test_average_before_and_after_the_join_agree(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("track"),
        (F.col("id") % 4).cast("int").alias("year"),
        (F.col("id") % 17).cast("double").alias("popularity"),
    )
    genres = spark.range(50).select(F.col("id").alias("track"), (F.col("id") % 5).alias("genre"))
    early = tables.average_by_joined(facts, genres, "track", ["genre", "year"], "popularity", "a")
    late = tables.average_by(facts.join(genres, "track"), ["genre", "year"], "popularity", "a")
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.collect()))


def test_key_split_is_stable_and_near_its_share(spark):
    df = spark.range(5000)
    split = df.withColumn("t", tables.key_split(df, "id", 0.8))
    again = df.repartition(3).withColumn("t", tables.key_split(df.repartition(3), "id", 0.8))
    assert split.exceptAll(again).count() == 0
    assert 0.77 < split.where("t").count() / 5000 < 0.83


def test_random_split_covers_every_row_once(spark):
    train, test = tables.random_split(spark.range(2000))
    assert train.unionAll(test).distinct().count() == train.count() + test.count() == 2000


def test_csv_types(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(1, "a", 0.5)], "i int, s string, d double").write.csv(path, header=True)
    assert dict(read_csv(spark, path).dtypes) == {"i": "int", "s": "string", "d": "double"}
    assert read_csv(spark, path, "i bigint, s string, d string").first()[2] == "0.5"


def test_small_join_with_and_without_broadcast(spark):
    large = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"))
    small = spark.range(90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    near = joins.join_small(large, small, "k", 1000)
    far = joins.join_small(large, small, "k", joins.BROADCAST_BYTES + 1)
    assert near.columns == far.columns
    assert near.exceptAll(far).count() == far.exceptAll(near).count() == 0


def test_a_large_table_is_merged(spark):
    large = spark.range(4000).select("id", (F.col("id") % 1 + 7).alias("k"))
    small = spark.createDataFrame([(7, 1)], "k bigint, v int")
    far = joins.join_small(large, small, "k", joins.BROADCAST_BYTES + 1)
    assert far.count() == 4000 and "SortMergeJoin [k" in far._jdf.queryExecution().toString()


def test_infinities_are_not_counted(spark):
    values = [1.0, 2.0, 3.0, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [(r.lo, r.hi, r.n) for r in tables.histogram(df, "x", 2).collect()] == [(1.0, 2.0, 1), (2.0, 3.0, 2)]


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), ("ä", 2)], "w string, n int")
    assert tuple(joins.measure(df)) == (2, 3 + 2 + 2 * 16 + 2 * 16)


def test_a_null_key_is_in_one_part(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    in_train = tables.key_split(df, "k", 0.5)
    assert df.where(in_train).count() + df.where(~in_train).count() == 3
    assert df.where(~in_train).where("k is null").count() == 1
