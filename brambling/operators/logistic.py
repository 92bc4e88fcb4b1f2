"""Logistic regression on standardized sparse features, by gradient descent with an adaptive rate.

Standardizing makes sparse vectors dense. Instead of storing them, the scaling is folded into the
coefficients: with a_j = shrink * theta_j / std_j the margin of a document is

    z = sum_j x_j * a_j  -  sum_j mean_j * a_j  +  shrink * theta_intercept

and with r = sigmoid(z) - y the gradient is

    g_j = shrink / std_j * (sum_i r_i * x_ij  -  mean_j * sum_i r_i),    g_intercept = shrink * sum_i r_i

so every sum over documents touches only the non-zero entries. Loss and gradient come from one
pass: a task sums its own documents, batch by batch, the sums are added per rank after a shuffle of
one row per task and rank, and one row per rank reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from brambling.operators.joins import join_small
from brambling.operators.text_features import RANK_ROW_BYTES, Dictionary, Scaler, fits

# Fixed values of the descent: start rate, factors after a kept and an undone step, the change in
# loss at which it stops, the largest number of iterations, the seed of the start coefficients.
RATE, FASTER, SLOWER = 0.3, 1.2, 0.5
TOLERANCE, MAX_ITERATIONS, SEED = 0.1, 60, 10

# Pseudo ranks of the two sums that do not belong to a feature.
LOSS, RESIDUAL = -1, -2

# Entries that a task works on at a time, few enough for a core's cache.
ENTRIES = 1 << 15


def initial_theta(size: int, seed: int = SEED) -> np.ndarray:
    """Uniform start coefficients in [0, 1) for ``size`` features and the intercept."""
    return np.random.RandomState(seed).random_sample(size + 1)


@dataclass(frozen=True)
class Folded:
    """Mean and deviation per rank on the driver, to fold the scaling into coefficients."""

    mean: np.ndarray
    std: np.ndarray
    shrink: float

    @classmethod
    def of(cls, scaler: Scaler) -> Folded:
        stats = scaler.table.orderBy("rank").toPandas()
        return cls(stats["mean"].to_numpy(), stats["std"].to_numpy(), scaler.shrink)

    def weights(self, theta: np.ndarray) -> tuple[np.ndarray, float]:
        weights = self.shrink * theta[:-1] / self.std
        return weights, float(self.shrink * theta[-1] - weights @ self.mean)

    def gradient(self, sums: np.ndarray, residual: float) -> np.ndarray:
        inner = self.shrink / self.std * (sums - self.mean * residual)
        return np.append(inner, self.shrink * residual)


def margins(rows: DataFrame, theta: Sequence[float], folded: Folded) -> DataFrame:
    """``rows`` with the margin ``z`` = x . theta of each document.

    Coefficients up to the size that ``join_small`` broadcasts go to the tasks as one array, without a
    shuffle. More of them stay a table that entries are joined with by rank; ids must not repeat then.
    """
    weights, constant = folded.weights(np.asarray(theta, dtype=float))
    spark = rows.sparkSession
    if fits(len(weights)):
        # A scalar subquery reaches the tasks as one constant.
        table = spark.createDataFrame([(weights.tolist(),)], "w array<double>")
        dot = F.aggregate("entries", F.lit(0.0), lambda total, e: total + e["value"] * F.get("_w", e["rank"]))
        return rows.withColumn("_w", table.scalar()).withColumn("z", dot + F.lit(constant)).drop("_w")
    table = spark.createDataFrame(pa.table({"rank": pa.array(np.arange(len(weights)), pa.int32()), "_w": pa.array(weights)}))
    cells = rows.select("doc_id", F.explode("entries").alias("e")).select("doc_id", "e.rank", "e.value")
    joined = join_small(cells, table, "rank", len(weights) * RANK_ROW_BYTES)
    sums = joined.groupBy("doc_id").agg(F.sum(F.col("value") * F.col("_w")).alias("_dot"))
    return rows.join(sums, "doc_id", "left").withColumn("z", F.coalesce("_dot", F.lit(0.0)) + F.lit(constant)).drop("_dot")


def row_loss(z: Column | str, y: Column | str) -> Column:
    """-y z + ln(1 + e^z), in a form that cannot overflow."""
    z, y = (F.col(c) if isinstance(c, str) else c for c in (z, y))
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z


def total_loss(rows: DataFrame, theta: Sequence[float], scaler: Scaler) -> DataFrame:
    """One row: the summed loss of ``rows`` (with label ``y``) at ``theta``."""
    scored = margins(rows, theta, Folded.of(scaler))
    return scored.agg(F.sum(row_loss("z", "y")).alias("loss"))


def training_arrays(rows: DataFrame) -> DataFrame:
    """``(y, ranks, values)``, the form in which Arrow hands vectors to NumPy without copying."""
    return rows.select(
        F.col("y").cast("double").alias("y"),
        F.transform("entries", lambda e: e["rank"]).alias("ranks"),
        F.transform("entries", lambda e: e["value"]).alias("values"),
    )


def loss_and_sums(arrays: DataFrame, theta: np.ndarray, folded: Folded) -> DataFrame:
    """``(rank, total)``: sum of r * x per rank, and the loss and the sum of r under pseudo ranks."""
    weights, constant = folded.weights(theta)

    def task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, loss, residual = np.zeros(len(weights)), 0.0, 0.0
        for batch in batches:
            every_y, lengths = np.asarray(batch.column("y")), np.asarray(batch.column("ranks").value_lengths(), np.int64)
            ranks, values = (np.asarray(batch.column(name).flatten()) for name in ("ranks", "values"))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            first = 0
            while first < len(lengths):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + ENTRIES, side="right")) - 1)
                own = slice(int(ends[first]), int(ends[last]))
                y, number, rank, x = every_y[first:last], lengths[first:last], ranks[own], values[own]
                z = np.full(len(y), constant)
                some = number > 0
                if some.any():
                    z[some] += np.add.reduceat(x * weights[rank], (ends[first:last] - ends[first])[some])
                small = np.exp(-np.abs(z))
                loss += float(np.sum(np.maximum(z, 0) + np.log1p(small) - y * z))
                r = np.where(z >= 0, 1, small) / (1 + small) - y
                residual += float(r.sum())
                sums += np.bincount(rank, weights=x * np.repeat(r, number), minlength=len(weights))
                first = last
        found = np.flatnonzero(sums)
        ranks = np.concatenate([[LOSS, RESIDUAL], found])
        totals = np.concatenate([[loss, residual], sums[found]])
        yield pa.RecordBatch.from_pydict({"rank": pa.array(ranks, pa.int32()), "total": pa.array(totals, pa.float64())})

    return arrays.mapInArrow(task_sums, "rank int, total double").groupBy("rank").agg(F.sum("total").alias("total"))


def evaluate(arrays: DataFrame, theta: np.ndarray, folded: Folded) -> tuple[float, np.ndarray]:
    """Loss and gradient at ``theta`` from one job; at most one row per feature comes back."""
    totals = loss_and_sums(arrays, theta, folded).toArrow().to_pandas().set_index("rank")["total"]
    sums = totals.reindex(range(len(folded.mean)), fill_value=0.0).to_numpy()
    loss, residual = (float(totals.get(key, 0.0)) for key in (LOSS, RESIDUAL))
    return loss, folded.gradient(sums, residual)


def gradient(rows: DataFrame, theta: Sequence[float], scaler: Scaler) -> DataFrame:
    """``(rank, gradient)`` at ``theta``; the intercept has the last rank."""
    _, slope = evaluate(training_arrays(rows), np.asarray(theta, dtype=float), Folded.of(scaler))
    return coefficient_table(rows, slope, "gradient")


def coefficient_table(df: DataFrame, values: np.ndarray, name: str = "theta") -> DataFrame:
    table = pa.table({"rank": pa.array(np.arange(len(values)), pa.int32()), name: pa.array(np.asarray(values, dtype=float))})
    return df.sparkSession.createDataFrame(table)


@dataclass(frozen=True)
class LogisticModel:
    theta: np.ndarray
    loss: float
    iterations: int
    rejected: int
    scaler: Scaler

    def coefficients(self) -> DataFrame:
        return coefficient_table(self.scaler.table, self.theta)

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with margin ``z`` and ``prediction``: 1 above 0, else 0."""
        scored = margins(rows, self.theta, Folded.of(self.scaler))
        return scored.withColumn("prediction", F.when(F.col("z") > 0, 1).otherwise(0))

    def predict_all(self, ids: DataFrame, rows: DataFrame) -> DataFrame:
        """A prediction for every row of ``ids (doc_id, ...)``; null for those without a vector."""
        return ids.join(self.predict(rows).select("doc_id", "z", "prediction"), "doc_id", "left")


def fit_logistic(
    rows: DataFrame,
    scaler: Scaler,
    theta: Sequence[float] | None = None,
    rate: float = RATE,
    tolerance: float = TOLERANCE,
    max_iterations: int = MAX_ITERATIONS,
) -> LogisticModel:
    """Gradient descent on ``rows`` = ``(doc_id, entries, y)``.

    A step that lowers the loss is kept and the rate grows; otherwise it is undone and the rate
    halves. The search ends when a step changes the loss by less than ``tolerance``: that
    step's coefficients are returned together with the loss before it.

    Loss and gradient at a new point come from the same job, so an iteration is one pass. ``rows``
    are cached; hand over rows that ``store`` has written to the shared folder, so that a lost
    executor costs a read and not the whole text pipeline.
    """
    folded = Folded.of(scaler)
    current = initial_theta(scaler.size) if theta is None else np.asarray(theta, dtype=float)
    data = training_arrays(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        loss, slope = evaluate(data, current, folded)
        candidate, iterations, rejected = current, 0, 0
        while iterations < max_iterations:
            iterations += 1
            candidate = current - rate * slope
            new_loss, new_slope = evaluate(data, candidate, folded)
            if abs(new_loss - loss) < tolerance:
                break
            if new_loss < loss:
                rate *= FASTER
                current, loss, slope = candidate, new_loss, new_slope
            else:
                rate *= SLOWER
                rejected += 1
                candidate = current
    finally:
        data.unpersist()
    return LogisticModel(candidate, loss, iterations, rejected, scaler)


def top_coefficients(model: LogisticModel, dictionary: Dictionary, k: int = 10) -> DataFrame:
    """The ``k`` words with the largest coefficients; the intercept is not a word."""
    words = dictionary.table.select("word", "rank")
    return model.coefficients().join(words, "rank").orderBy(F.desc("theta"), "word").limit(k)


def classification_metrics(predicted: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, fn, tn, unscored, precision, recall, f1; a ratio over nothing is null.

    Rows without a prediction are counted as unscored and as nothing else.
    """
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = predicted.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(F.col(prediction).isNull()).alias("unscored"),
    )
    return (
        counts.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp")))
        .withColumn("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))
        .withColumn(
            "f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )
