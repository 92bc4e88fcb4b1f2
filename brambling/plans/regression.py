"""Splits, and a forest that predicts the length of a document from its words and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.functions.text import blank_runs
from brambling.operators import forest, tables
from brambling.plans.tables import read
from brambling.session import store

LABEL = "l_quantity"
SHARE, TOLERANCE = 0.8, 0.03
TREES = 100


def random_split(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows both parts have, how many rows are in both, and whether the share is as asked."""
    keys = read(spark, folder, "orders").select("o_orderkey")
    train, test = tables.random_split(keys, SHARE)
    sides = train.withColumn("side", F.lit(0)).unionAll(test.withColumn("side", F.lit(1)))
    each = sides.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("side") == 0).alias("a"))
    share = F.sum("a") / F.sum("n")
    return each.agg(
        F.sum("n").alias("total"),
        F.count_if((F.col("a") > 0) & (F.col("a") < F.col("n"))).alias("in_both"),
        (F.abs(share - SHARE) < TOLERANCE).alias("share_as_asked"),
    )


def key_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    return orders.select("o_orderkey", tables.key_split(orders, "o_orderkey", SHARE).alias("in_train"))


def rmse(spark: SparkSession, folder: str) -> DataFrame:
    """The error, on the test part, of the mean quantity per line number in the training part."""
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", LABEL)
    in_train = tables.key_split(lines, "l_orderkey", SHARE)
    means = tables.average_by(lines.where(in_train), ["l_linenumber"], LABEL, "prediction")
    error = forest.rmse(lines.where(~in_train).join(means, "l_linenumber"), LABEL)
    return error.select(F.round("rmse", 8).alias("rmse"))


def lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its number of words and lines, and its number of characters as the label."""
    docs = read(spark, folder, "documents")
    words, lines = F.size(blank_runs("text")), F.regexp_count("text", F.lit("\n")) + 1
    rows = docs.select("doc_id", F.col("n_chars").cast("double").alias("label"), words.alias("n_words"), lines.alias("n_lines"))
    return store(tables.drop_any_null(rows))


def rf_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of both parts, the number of trees, and whether the error on the test part is below half
    of the label's deviation there. The error itself depends on how rows lie in partitions."""
    rows = lengths(spark, folder)
    in_train = tables.key_split(rows, "doc_id", SHARE)
    parts = rows.agg(F.count_if(in_train).alias("n_train"), F.count_if(~in_train).alias("n_test"))
    inputs = ("n_words", "n_lines")
    model = forest.fit_forest(forest.assemble(rows.where(in_train), inputs), "label", TREES)
    predicted = model.transform(forest.assemble(rows.where(~in_train), inputs))
    spread = predicted.agg(F.stddev_pop("label").alias("spread"))
    judged = forest.rmse(predicted).join(spread).select((F.col("rmse") < F.col("spread") / 2).alias("learned"))
    return parts.join(judged).select("n_train", "n_test", F.lit(model.getNumTrees).alias("trees"), "learned")


QUERIES = {f.__name__: f for f in (random_split, key_split, rmse, rf_regression)}


def oracles() -> dict[str, str]:
    in_train = "('0x' || substr(md5({}::VARCHAR), 1, 8))::UBIGINT < " + str(int(SHARE * 2**32))
    by_order = in_train.format("l_orderkey")
    by_doc = in_train.format("doc_id")
    return {
        "random_split": "SELECT count(*) AS total, 0::BIGINT AS in_both, TRUE AS share_as_asked FROM orders",
        "rf_regression": (
            f"SELECT count_if({by_doc})::BIGINT AS n_train, count_if(NOT {by_doc})::BIGINT AS n_test,"
            f" {TREES}::INTEGER AS trees, TRUE AS learned FROM documents"
        ),
        "key_split": f"SELECT o_orderkey, {in_train.format('o_orderkey')} AS in_train FROM orders",
        "rmse": (
            f"WITH m AS (SELECT l_linenumber, avg(l_quantity) AS p FROM lineitem WHERE {by_order} GROUP BY ALL)"
            " SELECT round(sqrt(avg((l_quantity - p) ** 2)), 8) AS rmse FROM lineitem JOIN m USING (l_linenumber)"
            f" WHERE NOT ({by_order})"
        ),
    }
