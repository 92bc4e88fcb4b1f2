from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.operators import joins
from brambling.operators import logistic as lr
from brambling.operators import text_features as tf
from brambling.operators.neighbours import dense_rows
from brambling.session import store


@pytest.fixture(scope="module")
def embeddings(spark):
    """The first two elements of each vector, whose descent was worked out by hand."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = dense_rows(table, F.struct("vec_id", "label"), "embedding")
    rows = vectors.select(
        F.col("doc_id.vec_id").alias("doc_id"),
        F.slice("entries", 1, 2).alias("entries"),
        (F.col("doc_id.label") < 3).cast("int").alias("y"),
    ).cache()
    return rows, tf.fit_scaler(rows, 2)


def test_descent(embeddings):
    rows, scaler = embeddings
    model = lr.fit_logistic(rows, scaler, theta=[0.5] * 3)
    assert (model.iterations, model.rejected) == (29, 0)
    assert np.round(model.theta, 4).tolist() == [5.2686, 3.0178, -89.4346]
    assert round(model.loss, 4) == 299.1548


def test_descent_with_rejected_steps(embeddings):
    rows, scaler = embeddings
    model = lr.fit_logistic(rows, scaler, theta=[0.5] * 3, rate=500)
    assert (model.iterations, model.rejected) == (8, 3)
    assert np.round(model.theta, 4).tolist() == [5.3906, 3.0924, -91.9321]
    assert round(model.loss, 4) == 299.0636


def test_no_iteration_returns_the_start(embeddings):
    rows, scaler = embeddings
    model = lr.fit_logistic(rows, scaler, theta=[0.5] * 3, max_iterations=0)
    assert model.theta.tolist() == [0.5] * 3


@pytest.fixture(scope="module")
def sparse(spark):
    random = np.random.RandomState(3)
    x = random.rand(60, 6) * (random.rand(60, 6) < 0.5)
    x[:, 5] = 0
    y = (random.rand(60) < 0.4).astype(int)
    data = [(i, [(j, float(v)) for j, v in enumerate(row) if v], int(c)) for i, (row, c) in enumerate(zip(x, y))]
    schema = "doc_id int, entries array<struct<rank:int,value:double>>, y int"
    return x, y, spark.createDataFrame(data, schema).repartition(5).cache()


def test_folded_scaling_equals_dense_features(sparse):
    x, y, rows = sparse
    scaler = tf.fit_scaler(rows, 6)
    std = np.where(x.std(0) == 0, 1, x.std(0))
    dense = np.hstack([(x - x.mean(0)) / std * 0.01, np.full((60, 1), 0.01)])
    theta = np.linspace(-40, 60, 7)
    z = dense @ theta
    loss = np.sum(-y * z + np.log(1 + np.exp(z)))
    slope = dense.T @ (1 / (1 + np.exp(-z)) - y)

    folded = lr.Folded.of(scaler)
    got_loss, got_slope = lr.evaluate(lr.training_arrays(rows), theta, folded)
    assert np.isclose(got_loss, loss) and np.allclose(got_slope, slope)
    assert np.isclose(lr.total_loss(rows, theta, scaler).first()[0], loss)
    got_z = {r.doc_id: r.z for r in lr.margins(rows, theta, folded).collect()}
    assert np.allclose([got_z[i] for i in range(60)], z)
    table = lr.gradient(rows, theta, scaler).orderBy("rank").toPandas()
    assert np.allclose(table["gradient"], slope)
    cells = tf.standardize(rows, scaler, intercept=True).collect()
    wide = np.tile([v for _, _, v in sorted((r.rank, 0, r.value) for r in cells if r.doc_id is None)], (60, 1))
    for r in cells:
        if r.doc_id is not None:
            wide[r.doc_id, r.rank] = r.value
    assert np.allclose(wide, dense)


def test_loss_does_not_overflow(spark):
    df = spark.createDataFrame([(1000.0, 0), (-1000.0, 1), (1000.0, 1)], "z double, y int")
    assert [r[0] for r in df.select(lr.row_loss("z", "y")).collect()] == [1000.0, 1000.0, 0.0]


def test_predictions_and_top_words(spark):
    docs = [(f"AU{i}", "court law court") for i in range(6)] + [(f"{i}", "cat dog the") for i in range(6)]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    model, vectors = tf.fit_transform(df, 5)
    rows = vectors.withColumn("y", F.col("doc_id").startswith("AU").cast("int")).cache()
    fitted = lr.fit_logistic(rows, tf.fit_scaler(rows, 5), rate=50.0)
    metrics = lr.classification_metrics(fitted.predict(rows)).first()
    assert (metrics.tp, metrics.fp, metrics.fn, metrics.tn, metrics.f1) == (6, 0, 0, 6, 1.0)
    assert {r.word for r in lr.top_coefficients(fitted, model.dictionary, 2).collect()} == {"court", "law"}

    new = spark.createDataFrame([("n1", "court", 1), ("n2", "zebra", 1), ("n3", None, 0)], "doc_id string, text string, y int")
    scored = fitted.predict_all(new.select("doc_id", "y"), model.transform(new))
    assert {r.doc_id: r.prediction for r in scored.collect()} == {"n1": 1, "n2": None, "n3": None}
    row = lr.classification_metrics(scored).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.unscored) == (1, 0, 0, 0, 2)


def test_metrics(spark):
    pairs = [(1, 1), (1, 1), (1, 0), (0, 1), (0, 0)]
    row = lr.classification_metrics(spark.createDataFrame(pairs, "y int, prediction int")).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 1)
    assert row.precision == row.recall == 2 / 3 and abs(row.f1 - 2 / 3) < 1e-12


def test_metrics_over_nothing_are_null(spark):
    row = lr.classification_metrics(spark.createDataFrame([(0, 0)], "y int, prediction int")).first()
    assert (row.precision, row.recall, row.f1) == (None, None, None)


def test_start_coefficients():
    assert np.round(lr.initial_theta(2), 6).tolist() == [0.771321, 0.020752, 0.633648]


def test_tables_of_ranks_too_large_for_a_task(spark, monkeypatch):
    """Millions of ranks stay tables; both ways give the same values."""
    docs = spark.createDataFrame([(f"d{k}", " ".join(f"w{chr(97 + (k * j) % 7)}" for j in range(1, 9))) for k in range(30)], "doc_id string, text string")
    model, vectors = tf.fit_transform(docs, 20)
    rows = store(vectors.withColumn("y", (F.length("doc_id") > 2).cast("int")))
    scaler = tf.fit_scaler(rows, model.dictionary.size)
    theta = lr.initial_theta(scaler.size)

    def results():
        scored = {r.doc_id: round(r.z, 12) for r in lr.margins(rows, theta, lr.Folded.of(scaler)).collect()}
        cells = sorted((str(r.doc_id), r["rank"], round(r.value, 12)) for r in tf.standardize(rows, scaler, intercept=True).collect())
        return scored, cells, sorted((r.doc_id, len(r.entries)) for r in model.transform(docs).collect())

    near = results()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    assert not tf.fits(1) and results() == near and len(near[0]) == 30


def test_a_model_of_five_million_ranks(spark):
    size = 5_000_000
    folded = lr.Folded(np.zeros(size), np.ones(size), 0.01)
    rows = spark.range(20).select(
        F.col("id").alias("doc_id"), F.array(F.struct((F.col("id") * 200_000).cast("int").alias("rank"), F.lit(2.0).alias("value"))).alias("entries")
    )
    theta = np.arange(size + 1, dtype=float)
    got = {r.doc_id: r.z for r in lr.margins(rows, theta, folded).collect()}
    assert all(np.isclose(got[k], 0.01 * k * 200_000 * 2 + 0.01 * size) for k in range(20))


def test_sums_do_not_depend_on_how_many_entries_are_taken_at_a_time(spark, monkeypatch):
    """Documents without entries, and one with more than are taken at a time."""
    data = [(0, [], 1), (1, [(0, 2.0), (2, -1.0)], 0), (2, [], 0), (3, [(1, 0.5)], 1), (4, [(0, 1.0), (1, 3.0), (2, 0.25)], 0)]
    rows = spark.createDataFrame(data, "doc_id int, entries array<struct<rank:int,value:double>>, y int").coalesce(1)
    folded = lr.Folded(np.array([0.1, 0.2, 0.3]), np.array([1.0, 2.0, 0.5]), 0.01)
    theta = np.array([30.0, -20.0, 10.0, 5.0])
    weights, constant = folded.weights(theta)
    x = np.zeros((5, 3))
    for i, entries, _ in data:
        for rank, value in entries:
            x[i, rank] = value
    y = np.array([r[2] for r in data])
    z = x @ weights + constant
    r = 1 / (1 + np.exp(-z)) - y
    want = folded.gradient(x.T @ r, r.sum())
    for most in (1, 2, 1 << 15):
        monkeypatch.setattr(lr, "ENTRIES", most)
        loss, slope = lr.evaluate(lr.training_arrays(rows), theta, folded)
        assert np.allclose(slope, want) and np.isclose(loss, np.sum(np.log1p(np.exp(z)) - y * z))
