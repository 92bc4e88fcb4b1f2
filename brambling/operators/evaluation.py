"""Measures of a classifier with any number of classes, all from one count of (label, prediction).

A row without label says nothing about a classifier and is left out. A row without prediction counts
for its label: it is wrong, and missing from the predictions of every class. A class is any value that
occurs as a label or as a prediction. A ratio over nothing counts as 0 in averages and is null in the
table of classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.session import cut


def confusion_cells(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` for the pairs that occur; at most one row per two classes."""
    named = predicted.select(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
    return cut(named.where("label is not null").groupBy("label", "prediction").agg(F.count("*").alias("n")))


def classes_of(cells: DataFrame) -> DataFrame:
    both = cells.select(F.col("label").alias("class")).unionByName(cells.select(F.col("prediction").alias("class")))
    return both.where("class is not null").distinct()


def confusion_table(cells: DataFrame) -> DataFrame:
    """``(label, prediction, n)`` for each two classes, also where n is 0, and for labels without prediction."""
    names = classes_of(cells).agg(F.sort_array(F.collect_list("class")).alias("all"))
    # One array of K classes, for a table that has K x K rows.
    each = classes_of(cells).withColumn("all", names.scalar()).select(F.col("class").alias("label"), F.explode("all").alias("prediction"))
    unscored = cells.where("prediction is null").select("label", "prediction")
    known = cells.withColumnRenamed("n", "_n")
    same = known["label"].eqNullSafe(F.col("e.label")) & known["prediction"].eqNullSafe(F.col("e.prediction"))
    return each.unionByName(unscored).alias("e").join(known, same, "left").select("e.label", "e.prediction", F.coalesce("_n", F.lit(0)).alias("n"))


def _over(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def class_measures(cells: DataFrame, beta: float = 1.0) -> DataFrame:
    """One row per class: support, predicted, tp, fp, fn, precision, recall, false-positive rate, f."""
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_label = cells.select(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("predicted"), hit.alias("tp"))
    as_prediction = cells.where("prediction is not null").select(F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("n").alias("predicted"), F.lit(0).alias("tp"))
    sums = as_label.unionByName(as_prediction).groupBy("class").agg(*(F.sum(c).cast("bigint").alias(c) for c in ("support", "predicted", "tp")))
    rows = sums.withColumn("all", total.scalar()).withColumns({"fp": F.col("predicted") - F.col("tp"), "fn": F.col("support") - F.col("tp")})
    rows = rows.withColumns(
        {
            "precision": _over(F.col("tp"), F.col("predicted")),
            "recall": _over(F.col("tp"), F.col("support")),
            "fpr": _over(F.col("fp"), F.col("all") - F.col("support")),
        }
    )
    p, r = F.coalesce("precision", F.lit(0.0)), F.coalesce("recall", F.lit(0.0))
    return rows.withColumn("f", F.coalesce(_over((1 + beta**2) * p * r, beta**2 * p + r), F.lit(0.0))).drop("all")


def summary(measures: DataFrame) -> DataFrame:
    """One row from ``class_measures``: accuracy, Hamming loss, and macro and weighted averages.

    Weights are the supports, as in the averages of ``pyspark.ml.evaluation``. Over no rows all are
    null.
    """
    zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    names = ("precision", "recall", "f")
    macro = [F.avg(zero(n)).alias(f"macro_{n}") for n in names]
    weighted = [F.try_divide(F.sum(zero(n) * F.col("support")), F.sum("support")).alias(f"weighted_{n}") for n in (*names, "fpr")]
    accuracy = F.try_divide(F.sum("tp"), F.sum("support"))
    return measures.agg(F.count("*").alias("classes"), F.sum("support").alias("rows"), accuracy.alias("accuracy"), (1 - accuracy).alias("hamming_loss"), *macro, *weighted)


def log_loss(predicted: DataFrame, place: str, probabilities: str, least: float = 1e-15) -> DataFrame:
    """One row: the mean of -ln of the probability given to the label, whose number is in ``place``.

    A label beyond the classes has probability 0, and probabilities below ``least`` count as that.
    Rows without label or probabilities are left out.
    """
    given = F.coalesce(F.get(F.col(probabilities), F.col(place).cast("int")), F.lit(0.0))
    usable = predicted.where(F.col(place).isNotNull() & F.col(probabilities).isNotNull())
    return usable.agg(F.avg(-F.log(F.greatest(F.lit(least), given))).alias("log_loss"))
