"""Documents to training tokens: each stage works on all that the one before it kept.

1. Documents that the quality classifier scores below 0.7 go. It learns from the labels of three
   folds of four; documents without label are judged like all others.
2. Of each group of near copies, in the sense of operator 8 (four words, 85 %), the document with the
   smallest id stays.
3. Documents of which a twentieth or more is benchmark text go.
4. Sources are mixed to their target weights: a document is repeated 0 to 3 times.
5. What is left is encoded, written to token files, and read back: one row per document and copy. The
   string of a special token gives its id, as the library does by default.

Stages 1 to 4 return the columns of their input. Null and empty texts pass stage 1 by their score,
link with nothing in stage 2, are never contaminated, have size 0, and encode to the end token.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.llm import decontamination, jaccard_join, mixing, quality, token_files
from brambling.llm.common import fold, fresh, read
from brambling.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

GOOD = 0.7
# The second stage is operator 8, so its contract holds.
SHINGLE, PERCENT = 4, 85
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    name = fresh("_quality", docs.columns)
    return quality.with_score(docs, model, docs.columns, "text", name).where(F.col(name) >= GOOD).drop(name)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs, width=SHINGLE, percent=PERCENT)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.tokens_of(docs, TOKENIZER, special=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", unseen),
    ("mixing sources", mixed),
    ("token-ID output", encoded),
]

# The classifier that the first stage trains cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
