from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from brambling.operators import forest
from brambling.operators.tables import random_split


def test_forest_beats_the_mean(spark):
    df = spark.range(1500).select(
        (F.col("id") % 10).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        ((F.col("id") % 10) * 3 + F.col("id") % 7).cast("double").alias("label"),
    )
    train, test = random_split(forest.assemble(df, ["a", "b"]))
    predicted = forest.fit_forest(train, "label", trees=10).transform(test).cache()
    error = forest.rmse(predicted).first()[0]
    assert error < 0.5 * test.agg(F.stddev_pop("label")).first()[0]
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    assert abs(evaluator.evaluate(predicted) - error) < 1e-9
