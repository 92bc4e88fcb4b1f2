"""Random forests: regression and its error, and classification into any number of classes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.operators.categories import CategoryIndex, Layout, fit_index, fit_layout, free_name


def assemble(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``df`` with its numeric ``inputs`` as one ``features`` vector."""
    return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(df)


def fit_forest(train: DataFrame, label: str, trees: int = 100, seed: int = 42) -> RandomForestRegressionModel:
    forest = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)
    return forest.fit(train)


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: the root of the mean squared error."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


@dataclass(frozen=True)
class ForestClassifier:
    """A forest on columns as they are: classes of any type, numbers and categories as features.

    Classes are numbered by a ``CategoryIndex``, features laid out by a ``Layout``; both come from the
    training rows. A category not seen in training, and null, have features of their own; a number
    that is null or NaN counts as 0.
    """

    forest: RandomForestClassificationModel
    classes: CategoryIndex
    layout: Layout

    @classmethod
    def fit(
        cls, train: DataFrame, label: str, numeric: Sequence[str] = (), categorical: Sequence[str] = (), trees: int = 20, depth: int = 5, seed: int = 42
    ) -> ForestClassifier:
        """Rows without label are not learned from."""
        known = train.where(F.col(label).isNotNull())
        classes = fit_index(known, label)
        if classes.size < 2:
            raise ValueError("a classifier needs rows of two classes at least")
        layout = fit_layout(known, tuple(numeric), tuple(categorical))
        place, features = free_name("_class", known), free_name("_features", known)
        rows = layout.vectors(classes.place_of(known, label, place), features)
        rows = rows.select(F.col(place).cast("double").alias(place), features)
        learner = RandomForestClassifier(labelCol=place, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed)
        return cls(learner.fit(rows), classes, layout)

    @property
    def trees(self) -> int:
        return self.forest.getNumTrees

    def scores(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probabilities`` and ``votes``, both arrays by class number.

        A tree votes for the most frequent class of the leaf that a row falls into, the first of equal
        ones; the probability of a class is the mean of its shares in these leaves.
        """
        features, score, place = (free_name(n, df) for n in ("_features", "_score", "_class"))
        model = self.forest.copy({self.forest.featuresCol: features, self.forest.probabilityCol: score, self.forest.predictionCol: place, self.forest.rawPredictionCol: ""})
        scored = model.transform(self.layout.vectors(df, features))
        chosen = []
        for k, tree in enumerate(self.forest.trees):
            name = free_name(f"_tree_{k}", df)
            own = tree.copy({tree.featuresCol: features, tree.predictionCol: name, tree.rawPredictionCol: "", tree.probabilityCol: ""})
            scored = own.transform(scored)
            chosen.append(F.col(name).cast("int"))
        picked = F.array(*chosen)
        votes = F.transform(F.sequence(F.lit(0), F.lit(self.classes.size - 1)), lambda c: F.size(F.filter(picked, lambda v: v == c)))
        return scored.select(*df.columns, vector_to_array(score).alias("probabilities"), votes.alias("votes"))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``scores`` with the class of the highest probability, the more frequent of equal ones."""
        scored = self.scores(df)
        place = free_name("_class", scored)
        best = F.array_position("probabilities", F.array_max("probabilities")) - 1
        return self.classes.value_of(scored.withColumn(place, best), place, name).drop(place)
