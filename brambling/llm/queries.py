"""The operators applied to the given tables, and the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.llm import decontamination, divergence, jaccard_join, language, licences, mixing, near_vectors, quality, secrets, token_files, toxicity, vector_codes, warc
from brambling.llm.common import fold, read
from brambling.session import scratch_path


# Scores from here on keep a document.
GOOD = 0.7


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents"), fold("doc_id", 4) == 2
    model = quality.fit(docs, read(spark, sf_dir, "labels"), ~held)
    scored = quality.with_score(docs, model, ["doc_id"], "text", "score")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(read(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"]))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held)
    scored = quality.with_score(docs, model, ["doc_id"], "text", "score")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op7_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokens_of(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(read(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(read(spark, sf_dir, "embeddings"))


def op13_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(read(spark, sf_dir, "documents")))


QUERIES = {q.__name__: q for q in (op1_quality_classifier, op2_language_id, op3_benchmark_decontamination, op4_toxicity, op5_secret_scans, op6_mixing, op7_token_id_output, op8_ngram_jaccard_join, op9_warc, op10_embedding_near_dedup, op11_source_divergence, op12_vector_codes, op13_license_scans)}
ORACLES = {
    "op3_benchmark_decontamination": decontamination.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op8_ngram_jaccard_join": jaccard_join.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_embedding_near_dedup": near_vectors.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
