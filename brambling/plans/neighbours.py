"""Nearest documents for the texts of ``benchmark``, and nearest vectors for every embedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.functions.text import label_from_path
from brambling.operators import neighbours as nn
from brambling.operators import saved
from brambling.operators import text_features as tf
from brambling.plans import fits, texts
from brambling.plans.tables import read

K = 10


def query_texts(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), "text")


def classifier(spark: SparkSession, folder: str) -> nn.TextClassifier:
    """The classifier on all documents, shared by the queries of a session."""
    fit = lambda path: saved.save(nn.TextClassifier.fit(texts.named_documents(spark, folder), texts.WORDS), path)
    return saved.load(spark, fits.once(spark, folder, "documents", "classifier", fit), nn.TextClassifier)


def knn_query_terms(spark: SparkSession, folder: str) -> DataFrame:
    words = texts.shared_model(spark, folder).dictionary
    return tf.bag_of_words(query_texts(spark, folder), words, "whitespace").withColumnRenamed("doc_id", "query_id")


def knn_distances(spark: SparkSession, folder: str) -> DataFrame:
    fitted = classifier(spark, folder)
    profile = nn.distance_profile(fitted.query_vectors(query_texts(spark, folder)), fitted.vectors)
    return profile.select(
        "query_id", "n_docs", *[F.round(f"{m}_distance", 6).alias(f"{m}_distance") for m in ("min", "mean", "max")]
    )


def knn_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    found = classifier(spark, folder).neighbours(query_texts(spark, folder), K)
    return found.withColumn("distance", F.round("distance", 6))


def knn_predict(spark: SparkSession, folder: str) -> DataFrame:
    return classifier(spark, folder).predict(query_texts(spark, folder), K)


def knn_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding classified by its nearest ones; their labels are part of their ids."""
    table = read(spark, folder, "embeddings")
    name = F.concat_ws("/", F.lit("vec"), F.col("label").cast("string"), F.col("vec_id").cast("string"))
    vectors = nn.dense_rows(table, name, "embedding")
    asked = nn.dense_rows(table, F.col("vec_id"), "embedding")
    ids = table.select(F.col("vec_id").alias("query_id"))
    return nn.classify(ids, nn.nearest(asked, vectors, K), label_from_path("doc_id"))


QUERIES = {f.__name__: f for f in (knn_query_terms, knn_distances, knn_neighbors, knn_predict, knn_dense)}

QUESTIONS = "SELECT item_id AS doc_id, text FROM benchmark"
VOTE = """,
ranked AS (
  SELECT query_id, doc_id, sqrt(squared) AS distance,
    row_number() OVER (PARTITION BY query_id ORDER BY squared, doc_id) AS position FROM pairs),
near AS (SELECT * FROM ranked WHERE position <= 10),
votes AS (
  SELECT query_id, string_split(doc_id, '/')[2] AS label, count(*) AS votes, min(position) AS best
  FROM near GROUP BY ALL),
winners AS (
  SELECT query_id, label, votes FROM votes
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, best) = 1)
"""


def oracles() -> dict[str, str]:
    questions = f"questions AS MATERIALIZED ({texts.bag_sql(QUESTIONS, 'whitespace')})"
    model = f"{texts.model_sql(texts.NAMED, texts.WORDS)}, {questions}"
    pairs = f"""WITH {model},
asked AS MATERIALIZED ({texts.tfidf_sql('questions')}),
dn AS (SELECT doc_id, sum(value * value) AS norm FROM tfidf GROUP BY doc_id),
qn AS (SELECT doc_id AS query_id, sum(value * value) AS norm FROM asked GROUP BY doc_id),
dots AS (
  SELECT a.doc_id AS query_id, t.doc_id, sum(a.value * t.value) AS dot
  FROM asked a JOIN tfidf t USING (rank) GROUP BY ALL),
pairs AS MATERIALIZED (
  SELECT query_id, doc_id, round(greatest(qn.norm + dn.norm - 2 * coalesce(dot, 0), 0), 10) AS squared
  FROM qn CROSS JOIN dn LEFT JOIN dots USING (query_id, doc_id))"""
    dense = """WITH e AS (SELECT vec_id, 'vec/' || label || '/' || vec_id AS doc_id, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (
  SELECT a.vec_id AS query_id, b.doc_id, round(list_distance(a.v, b.v) ** 2, 10) AS squared
  FROM e a CROSS JOIN e b)"""
    return {
        "knn_query_terms": f"WITH {model} SELECT doc_id AS query_id, rank, cnt FROM questions",
        "knn_distances": pairs
        + " SELECT query_id, count(*) AS n_docs, round(min(sqrt(squared)), 6) AS min_distance,"
        " round(avg(sqrt(squared)), 6) AS mean_distance, round(max(sqrt(squared)), 6) AS max_distance"
        " FROM pairs GROUP BY query_id",
        "knn_neighbors": pairs
        + VOTE
        + "SELECT query_id, doc_id, position::INTEGER AS position, round(distance, 6) AS distance FROM near",
        "knn_predict": pairs
        + VOTE
        + "SELECT item_id AS query_id, label, votes FROM benchmark LEFT JOIN winners ON item_id = query_id",
        "knn_dense": dense
        + VOTE
        + "SELECT vec_id AS query_id, w.label, votes FROM embeddings LEFT JOIN winners w ON vec_id = query_id",
    }
