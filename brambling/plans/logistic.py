"""Is a document English? Logistic regression on TF-IDF features of ``documents``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.functions.text import label_from_prefix
from brambling.operators import logistic as lr
from brambling.operators import saved
from brambling.operators import text_features as tf
from brambling.operators.neighbours import dense_rows
from brambling.operators.tables import key_split
from brambling.plans import fits, texts
from brambling.plans.tables import read
from brambling.session import store

WORDS = 20_000
TOP = 50
TRAIN_SHARE = 0.8
CLASS_PREFIX = "docs/en"


@dataclass(frozen=True)
class Training:
    """Text model, sparse features with label ``y``, and the scaler of a training corpus."""

    model: tf.TextModel
    rows: DataFrame
    scaler: tf.Scaler

    @classmethod
    def of(cls, docs: DataFrame, size: int = WORDS) -> Training:
        model, vectors = tf.fit_transform(docs, size)
        rows = store(labelled(vectors))
        return cls(model, rows, tf.fit_scaler(rows, model.dictionary.size))

    def features(self, docs: DataFrame) -> DataFrame:
        return self.model.transform(docs)

    def save(self, path: str) -> None:
        saved.save(self.model, f"{path}/model")
        saved.save(self.scaler, f"{path}/scaler")
        self.rows.write.parquet(f"{path}/rows")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Training:
        model, scaler = saved.load(spark, f"{path}/model", tf.TextModel), saved.load(spark, f"{path}/scaler", tf.Scaler)
        return cls(model, spark.read.parquet(f"{path}/rows"), scaler)


def labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("y", label_from_prefix("doc_id", CLASS_PREFIX))


def whole(spark: SparkSession, folder: str, size: int = WORDS) -> Training:
    """The training on all documents, shared by the queries of a session."""
    docs = texts.named_documents(spark, folder)
    return Training.load(spark, fits.once(spark, folder, "documents", f"training-{size}", lambda path: Training.of(docs, size).save(path)))


def parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = texts.named_documents(spark, folder)
    in_train: Column = key_split(docs, "doc_id", TRAIN_SHARE)
    return docs.where(in_train), docs.where(~in_train)


def rounded(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", F.round("value", 7))


def feature_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = whole(spark, folder).scaler.table
    return stats.select("rank", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


def standardize(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    return rounded(tf.standardize(training.rows, training.scaler))


def standardize_new_docs(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    return rounded(tf.standardize(training.features(texts.new_documents(spark, folder)), training.scaler))


def add_intercept(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    return rounded(tf.add_intercept(tf.standardize(training.rows, training.scaler), training.scaler.size))


def logreg_scores(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    start = lr.initial_theta(training.scaler.size)
    scored = lr.margins(training.rows, start, lr.Folded.of(training.scaler))
    return scored.select("doc_id", "y", F.round("z", 6).alias("z"))


def logreg_loss(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    loss = lr.total_loss(training.rows, lr.initial_theta(training.scaler.size), training.scaler)
    return loss.select(F.round("loss", 6).alias("loss"))


def logreg_gradient(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    slope = lr.gradient(training.rows, lr.initial_theta(training.scaler.size), training.scaler)
    return slope.select("rank", F.round("gradient", 6).alias("gradient"))


def fitted(spark: SparkSession, folder: str, name: str, training: Training) -> lr.LogisticModel:
    """The descent on ``training``, shared under ``name``."""
    fit = lambda path: saved.save(lr.fit_logistic(training.rows, training.scaler), path)
    return saved.load(spark, fits.once(spark, folder, "documents", name, fit), lr.LogisticModel)


def fit_rows(model: lr.LogisticModel) -> DataFrame:
    """Coefficients with the number of iterations and the loss of the fit."""
    return model.coefficients().select(
        "rank",
        F.round("theta", 4).alias("theta"),
        F.lit(model.iterations).alias("iterations"),
        F.round(F.lit(model.loss), 4).alias("loss"),
    )


def logreg_fit(spark: SparkSession, folder: str) -> DataFrame:
    return fit_rows(fitted(spark, folder, "descent", whole(spark, folder)))


def logreg_fit_dense(spark: SparkSession, folder: str) -> DataFrame:
    """The same fit on embeddings: is the label below 3?"""
    table = read(spark, folder, "embeddings")
    vectors = dense_rows(table.withColumn("_y", (F.col("label") < 3).cast("int")), F.struct("vec_id", "_y"), "embedding")
    rows = store(vectors.select(F.col("doc_id.vec_id").alias("doc_id"), "entries", F.col("doc_id._y").alias("y")))
    size = table.agg(F.max(F.size("embedding"))).first()[0]
    return fit_rows(lr.fit_logistic(rows, tf.fit_scaler(rows, size)))


def top_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    training = whole(spark, folder)
    best = lr.top_coefficients(fitted(spark, folder, "descent", training), training.model.dictionary, TOP)
    return best.select("rank", "word", F.round("theta", 4).alias("theta"))


def predicted(spark: SparkSession, folder: str) -> DataFrame:
    train, test = parts(spark, folder)
    training = Training.load(spark, fits.once(spark, folder, "documents", "training-part", lambda path: Training.of(train).save(path)))
    return fitted(spark, folder, "descent-part", training).predict_all(labelled(test.select("doc_id")), training.features(test))


def logreg_predict(spark: SparkSession, folder: str) -> DataFrame:
    return predicted(spark, folder).select("doc_id", "y", "prediction")


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = lr.classification_metrics(predicted(spark, folder))
    return metrics.select(
        "tp", "fp", "fn", "tn", "unscored", *[F.round(m, 8).alias(m) for m in ("precision", "recall", "f1")]
    )


QUERIES = {
    f.__name__: f
    for f in (
        feature_stats,
        standardize,
        standardize_new_docs,
        add_intercept,
        logreg_scores,
        logreg_loss,
        logreg_gradient,
        logreg_fit,
        logreg_fit_dense,
        top_coefficients,
        logreg_predict,
        classification_metrics,
    )
}
# The name from when the other fit had a small dictionary.
QUERIES["logreg_fit_large"] = logreg_fit


Y = f"starts_with(doc_id, '{CLASS_PREFIX}')::INTEGER AS y"


def loss_sql(theta: str) -> str:
    z = f"list_dot_product(x, {theta})"
    return f"sum(greatest({z}, 0) + ln(1 + exp(-abs({z}))) - y * {z})"


def descent_sql(start: list[float]) -> str:
    """CTEs ``steps`` and ``final``: one row per iteration of the descent over ``points``."""
    sums = (
        "(SELECT s.it, u.i, sum(p.x[u.i] * (1 / (1 + exp(-list_dot_product(p.x, s.theta))) - p.y)) AS g"
        " FROM steps s, points p, (SELECT unnest(range(1, (SELECT max(len(x)) FROM points) + 1)) AS i) u"
        " WHERE NOT s.stop AND s.it < 60 GROUP BY s.it, u.i)"
    )
    return f"""
steps AS (
  SELECT 0 AS it, {start}::DOUBLE[] AS theta, {start}::DOUBLE[] AS candidate, 0.3::DOUBLE AS rate,
    (SELECT {loss_sql(f'{start}::DOUBLE[]')} FROM points) AS loss, FALSE AS stop
  UNION ALL
  SELECT it + 1,
    CASE WHEN new_loss < loss THEN cand ELSE theta END,
    CASE WHEN abs(new_loss - loss) < 0.1 OR new_loss < loss THEN cand ELSE theta END,
    CASE WHEN new_loss < loss THEN rate * 1.2 ELSE rate * 0.5 END,
    CASE WHEN abs(new_loss - loss) < 0.1 THEN loss WHEN new_loss < loss THEN new_loss ELSE loss END,
    abs(new_loss - loss) < 0.1
  FROM (
    SELECT c.it, c.theta, c.cand, c.rate, c.loss, {loss_sql('c.cand')} AS new_loss
    FROM (
      SELECT s.it, s.theta, s.rate, s.loss,
        list_transform(list_zip(s.theta, k.grad), lambda p: p[1] - s.rate * p[2]) AS cand
      FROM steps s JOIN (SELECT it, list(g ORDER BY i) AS grad FROM {sums} GROUP BY it) k ON k.it = s.it
      WHERE NOT s.stop) c, points
    GROUP BY c.it, c.theta, c.cand, c.rate, c.loss)),
final AS MATERIALIZED (SELECT it, candidate, loss FROM steps ORDER BY it DESC LIMIT 1)"""


def sparse_margins_sql(name: str, theta: str, source: str, entries: str = "entries") -> str:
    """CTE ``name``: the margin of every document of ``entries`` at the coefficients ``theta``."""
    return f"""
{name}_t AS (SELECT unnest({theta}) AS t, generate_subscripts({theta}, 1) - 1 AS rank FROM {source}),
{name}_w AS (SELECT rank, mean, std, t, 0.01 * t / std AS a FROM {name}_t JOIN stats USING (rank)),
{name}_c AS (
  SELECT 0.01 * (SELECT t FROM {name}_t ORDER BY rank DESC LIMIT 1) - (SELECT sum(a * mean) FROM {name}_w) AS c),
{name} AS (
  SELECT doc_id, any_value(y) AS y, sum(value * a) + any_value(c) AS z
  FROM {entries} JOIN {name}_w USING (rank), {name}_c GROUP BY doc_id)"""


LOSS = "sum(greatest(z, 0) + ln(1 + exp(-abs(z))) - y * z)"


def sparse_training_sql(docs: str, size: int) -> str:
    """CTEs of a training corpus: the text model, ``stats``, ``entries``, and the margins ``zero`` at
    the coefficients ``start``."""
    start = lr.initial_theta(size).tolist()
    return f"""{texts.model_sql(docs, size)},
present AS MATERIALIZED (
  SELECT rank, count(*) / (SELECT count(DISTINCT doc_id) FROM tfidf) AS share, avg(value) AS a, var_pop(value) AS v
  FROM tfidf GROUP BY rank),
stats AS MATERIALIZED (
  SELECT rank, a * share AS mean, CASE WHEN v * share + a * a * share * (1 - share) = 0 THEN 1
    ELSE sqrt(v * share + a * a * share * (1 - share)) END AS std FROM present),
entries AS MATERIALIZED (SELECT doc_id, {Y}, rank, value FROM tfidf),
start AS MATERIALIZED (SELECT ({start}::DOUBLE[])[:(SELECT count(*) FROM stats) + 1] AS theta),
{sparse_margins_sql('zero', 'theta', 'start')}"""


def sparse_descent_sql(docs: str, size: int) -> str:
    """The descent on sparse vectors: CTEs up to ``final``, as ``descent_sql`` has them for dense ones."""
    loss = LOSS
    return f"""{sparse_training_sql(docs, size)},
steps AS (
  SELECT 0 AS it, theta, theta AS candidate, 0.3::DOUBLE AS rate, (SELECT {loss} FROM zero) AS loss, FALSE AS stop
  FROM start
  UNION ALL
  SELECT * FROM (
    WITH s AS (SELECT * FROM steps WHERE NOT stop AND it < 60),
    {sparse_margins_sql('now', 'theta', 's')},
    r AS (SELECT doc_id, 1 / (1 + exp(-z)) - y AS r FROM now),
    total AS (SELECT sum(r) AS r FROM r),
    g AS (SELECT rank, sum(value * r) AS g FROM entries JOIN r USING (doc_id) GROUP BY rank),
    moved AS (
      SELECT list_append(list(t - rate * 0.01 / std * (g - mean * total.r) ORDER BY rank),
        any_value(s.theta[len(s.theta)] - rate * 0.01 * total.r)) AS cand
      FROM now_w JOIN g USING (rank), s, total),
    {sparse_margins_sql('next', 'cand', 'moved')},
    l AS (SELECT {loss} AS new_loss FROM next)
    SELECT it + 1, CASE WHEN new_loss < loss THEN cand ELSE theta END,
      CASE WHEN abs(new_loss - loss) < 0.1 OR new_loss < loss THEN cand ELSE theta END,
      CASE WHEN new_loss < loss THEN rate * 1.2 ELSE rate * 0.5 END,
      CASE WHEN abs(new_loss - loss) < 0.1 THEN loss ELSE least(new_loss, loss) END,
      abs(new_loss - loss) < 0.1
    FROM s, moved, l)),
final AS MATERIALIZED (SELECT it, candidate, loss FROM steps ORDER BY it DESC LIMIT 1)"""


def scaled_sql(vectors: str) -> str:
    """Standardized entries, and with a null id the value of each rank in documents that lack it."""
    return (
        f"SELECT doc_id, rank, round((value - mean) / std * 0.01, 7) AS value FROM {vectors} JOIN stats USING (rank)"
        " UNION ALL SELECT NULL, rank, round((0 - mean) / std * 0.01, 7) FROM stats"
    )


def oracles() -> dict[str, str]:
    model = f"WITH {sparse_training_sql(texts.NAMED, WORDS)}"
    in_train = f"('0x' || substr(md5(doc_id), 1, 8))::UBIGINT < {int(TRAIN_SHARE * 2**32)}"
    new_vectors = f"new AS MATERIALIZED ({texts.tfidf_sql(f'({texts.bag_sql(texts.NEW)})')})"
    fit = f"WITH RECURSIVE {sparse_descent_sql(texts.NAMED, WORDS)}"
    test_docs = f"SELECT * FROM ({texts.NAMED}) WHERE NOT {in_train}"
    held_out = (
        f"WITH RECURSIVE {sparse_descent_sql(f'SELECT * FROM ({texts.NAMED}) WHERE {in_train}', WORDS)},"
        f" test AS (SELECT doc_id, {Y}, rank, value FROM ({texts.tfidf_sql(f'({texts.bag_sql(test_docs)})')})),"
        f" {sparse_margins_sql('scores', 'candidate', 'final', 'test')},"
        f" predicted AS (SELECT t.doc_id, t.y, (z > 0)::INTEGER AS prediction"
        f" FROM (SELECT doc_id, {Y} FROM ({test_docs})) t LEFT JOIN scores USING (doc_id))"
    )
    fit_columns = (
        "SELECT (i - 1)::INTEGER AS rank, round(candidate[i], 4) AS theta, it::INTEGER AS iterations, round(loss, 4) AS loss"
        " FROM final, (SELECT unnest(range(1, (SELECT len(candidate) FROM final) + 1)) AS i)"
    )
    gradient = (
        "r AS (SELECT doc_id, 1 / (1 + exp(-z)) - y AS r FROM zero), total AS (SELECT sum(r) AS r FROM r),"
        " g AS (SELECT rank, sum(value * r) AS g FROM entries JOIN r USING (doc_id) GROUP BY rank)"
        " SELECT rank, round(0.01 / std * (g - mean * total.r), 6) AS gradient FROM g JOIN stats USING (rank), total"
        " UNION ALL SELECT (SELECT count(*) FROM stats)::INTEGER, round(0.01 * r, 6) FROM total"
    )
    dense = f"""WITH RECURSIVE
cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
stats AS (SELECT i, avg(v) AS mean, stddev_pop(v) AS std FROM cells GROUP BY i),
points AS MATERIALIZED (
  SELECT vec_id, (label < 3)::INTEGER AS y, list_append(list((v - mean) / std * 0.01 ORDER BY i), 0.01::DOUBLE) AS x
  FROM cells JOIN stats USING (i) GROUP BY vec_id, label),
{descent_sql(lr.initial_theta(64).tolist())}"""
    return {
        "feature_stats": f"{model} SELECT rank, round(mean, 8) AS mean, round(std, 8) AS std FROM stats",
        "standardize": f"{model} {scaled_sql('tfidf')}",
        "standardize_new_docs": f"{model}, {new_vectors} {scaled_sql('new')}",
        "add_intercept": f"{model} {scaled_sql('tfidf')} UNION ALL SELECT NULL, (SELECT count(*) FROM stats)::INTEGER, 0.01",
        "logreg_scores": f"{model} SELECT doc_id, y, round(z, 6) AS z FROM zero",
        "logreg_loss": f"{model} SELECT round({LOSS}, 6) AS loss FROM zero",
        "logreg_gradient": f"{model}, {gradient}",
        "logreg_fit": f"{fit} {fit_columns}",
        "logreg_fit_large": f"{fit} {fit_columns}",
        "logreg_fit_dense": f"{dense} {fit_columns}",
        "top_coefficients": f"{fit} SELECT rank, word, round(candidate[rank + 1], 4) AS theta FROM dict, final"
        f" ORDER BY candidate[rank + 1] DESC, word LIMIT {TOP}",
        "logreg_predict": f"{held_out} SELECT doc_id, y, prediction FROM predicted",
        "classification_metrics": f"{held_out}, c AS (SELECT count_if(y = 1 AND prediction = 1) AS tp,"
        " count_if(y = 0 AND prediction = 1) AS fp, count_if(y = 1 AND prediction = 0) AS fn,"
        " count_if(y = 0 AND prediction = 0) AS tn, count_if(prediction IS NULL) AS unscored FROM predicted),"
        " m AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r FROM c)"
        " SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn, unscored::BIGINT AS unscored, round(p, 8) AS precision,"
        " round(r, 8) AS recall, round(2 * p * r / nullif(p + r, 0), 8) AS f1 FROM m",
    }
