"""Text features: dictionary of frequent words, bag of words, TF-IDF, standardization.

A document stays one row: ``(doc_id, entries, n_words)`` with the rank and count of each dictionary
word in it. One exchange by ``doc_id`` brings texts that share an id together; words are counted
behind it and looked up in the dictionary. Frequencies and TF-IDF values are expressions on that row. The id
column may have any type and is always named ``doc_id``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brambling.functions.text import blank_runs, letter_runs, words
from brambling.operators import joins
from brambling.operators.joins import join_small, measure
from brambling.session import cut, spread, store

# A dictionary row without its word: rank, count and row overhead.
RANK_ROW_BYTES = 48
# Text whose words a task counts per document: the counts take about 15 times as much.
TEXT_BYTES = 16 << 20


def tokenize(docs: DataFrame) -> DataFrame:
    """``(doc_id, words)`` with the words of each text in order."""
    return docs.select("doc_id", words("text").alias("words"))


def word_rows(docs: DataFrame, tokenizer: str = "letters") -> DataFrame:
    """``docs`` with one row per word instead of ``text``.

    ``letters`` splits at everything but ASCII letters; ``whitespace`` leaves punctuation on.
    """
    keys = [c for c in docs.columns if c != "text"]
    return docs.select(*keys, F.explode(_pieces(tokenizer)).alias("word")).withColumn("word", F.lower("word"))


def _pieces(tokenizer: str) -> Column:
    if tokenizer not in ("letters", "whitespace"):
        raise ValueError(f"unknown tokenizer {tokenizer!r}")
    return letter_runs("text") if tokenizer == "letters" else blank_runs("text")


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, cnt)`` over all texts, counted in each task before the shuffle."""
    return word_rows(spread(docs.select("text"))).groupBy("word").agg(F.count("*").alias("cnt"))


def top_words(counts: DataFrame, size: int) -> DataFrame:
    """``(word, rank, cnt)`` of the ``size`` most frequent words, rank 0 first, ties by word.

    Each task keeps at most ``size`` of its rows while it counts, and only these are merged; the
    vocabulary is neither sorted nor written. A null word, if there is one, comes first, has rank -1
    and is not one of the ``size``.
    """
    order = [F.col("word").isNotNull(), F.desc("cnt"), F.asc("word")]
    kept = counts.orderBy(*order).limit(size + 1)
    rank = F.row_number().over(Window.orderBy(*order)) - 1
    numbered = kept.withColumn("rank", (rank - F.max(F.col("word").isNull().cast("int")).over(Window.orderBy(*order))).cast("int"))
    return numbered.where(F.col("rank") < size).select("word", "rank", "cnt")


def texts_and_top_words(docs: DataFrame, size: int) -> DataFrame:
    """``top_words`` of all texts, and in the same pass the number of texts, as that of a null word."""
    pieces = F.coalesce(letter_runs("text"), F.array().cast("array<string>"))
    rows = spread(docs.select("text")).select(F.explode(F.concat(pieces, F.array(F.lit(None).cast("string")))).alias("word"))
    return top_words(rows.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("cnt")), size)


def fits(ranks: int) -> bool:
    """Whether a table with a row per rank may go to every task."""
    return ranks * RANK_ROW_BYTES <= joins.BROADCAST_BYTES


@dataclass(frozen=True)
class Dictionary:
    """A materialised dictionary: its table, number of words and measured size, and the number of
    documents it was counted in."""

    table: DataFrame
    size: int
    nbytes: int
    n_docs: int

    @property
    def rank_bytes(self) -> int:
        """Upper bound for a table with one numeric row per rank."""
        return self.size * RANK_ROW_BYTES


def fit_dictionary(docs: DataFrame, size: int) -> Dictionary:
    rows = cut(texts_and_top_words(docs, size))
    n_docs = rows.where("word is null").select("cnt").first()
    table = rows.where("word is not null")
    return Dictionary(table, *measure(table), n_docs[0] if n_docs else 0)


def text_parts(docs: DataFrame) -> int:
    """Into how many parts of about ``TEXT_BYTES`` the texts go; at least one per core."""
    nbytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(nbytes / TEXT_BYTES))


def bag_of_words(docs: DataFrame, dictionary: Dictionary, tokenizer: str = "letters") -> DataFrame:
    """``(doc_id, rank, cnt)``, one row per document and dictionary word in it.

    Texts are dealt out by ``doc_id``, which is the smallest form they have, and counted per document
    and word where they are. They are measured first, so that a task counts about ``TEXT_BYTES`` of
    them however many there are. The counts are unique per document and word, so even a word that every
    document has meets the dictionary no more often than there are documents.
    """
    texts = docs.select("doc_id", "text")
    texts = texts.repartition(text_parts(texts), "doc_id")
    rows = texts.select("doc_id", F.explode(_pieces(tokenizer)).alias("word")).withColumn("word", F.lower("word"))
    counted = rows.groupBy("doc_id", "word").agg(F.count("*").alias("cnt"))
    return join_small(counted, dictionary.table.select("word", "rank"), "word", dictionary.nbytes).select("doc_id", "rank", "cnt")


def bags(docs: DataFrame, dictionary: Dictionary, tokenizer: str = "letters") -> DataFrame:
    """``(doc_id, entries, n_words)``: entries ``(rank, cnt)`` by rank, and the sum of the counts.

    Documents without a dictionary word have no row.
    """
    # A document has at most one entry per dictionary word.
    entries = F.sort_array(F.collect_list(F.struct("rank", "cnt")))
    return bag_of_words(docs, dictionary, tokenizer).groupBy("doc_id").agg(entries.alias("entries"), F.sum("cnt").alias("n_words"))


def bag_rows(bags: DataFrame) -> DataFrame:
    """``(doc_id, rank, cnt)``, one row per document and dictionary word in it."""
    return bags.select("doc_id", F.explode("entries").alias("e")).select("doc_id", "e.rank", "e.cnt")


def document_frequency(bags: DataFrame) -> DataFrame:
    """``(rank, df)``: in how many documents each dictionary word occurs."""
    return bags.select(F.explode("entries.rank").alias("rank")).groupBy("rank").agg(F.count("*").alias("df"))


def inverse_document_frequency(frequency: DataFrame, n_docs: int) -> DataFrame:
    """``(rank, idf)`` with idf = ln(N / df)."""
    return frequency.select("rank", F.log(F.lit(float(n_docs)) / F.col("df")).alias("idf"))


def term_frequency(bags: DataFrame) -> DataFrame:
    """``(doc_id, rank, cnt, n_words, tf)``: the share of each word in the document's known words."""
    each = bags.select("doc_id", "n_words", F.explode("entries").alias("e"))
    return each.select("doc_id", "e.rank", "e.cnt", "n_words", (F.col("e.cnt") / F.col("n_words")).alias("tf"))


@dataclass(frozen=True)
class TextModel:
    """Dictionary and IDF of a training corpus, applied to any documents."""

    dictionary: Dictionary
    idf: DataFrame

    def transform(self, docs: DataFrame, tokenizer: str = "letters") -> DataFrame:
        """``(doc_id, entries)``: the TF-IDF vectors of ``docs``; texts without a known word have none."""
        return tfidf(bags(docs, self.dictionary, tokenizer), self.idf, self.dictionary)


def _by_rank(table: DataFrame, size: int, *columns: str) -> Column:
    """The columns of a table with one row per rank as a struct of arrays: one scalar subquery."""
    ranks = table.sparkSession.range(size).select(F.col("id").cast("int").alias("rank"))
    every = ranks.join(table, "rank", "left").agg(F.array_sort(F.collect_list(F.struct("rank", *columns))).alias("s"))
    return every.select(F.struct(*[F.col(f"s.{name}").alias(name) for name in columns])).scalar()


def tfidf(bags: DataFrame, idf: DataFrame, dictionary: Dictionary) -> DataFrame:
    """``(doc_id, entries)`` with entries ``(rank, value)`` by rank. Ranks without IDF have no entry."""
    share = lambda e: e["cnt"] / F.col("n_words")
    if fits(dictionary.size):
        rows = bags.withColumn("_s", _by_rank(idf, dictionary.size, "idf"))
        value = lambda e: share(e) * F.get("_s.idf", e["rank"])
        entries = F.transform("entries", lambda e: F.struct(e["rank"].alias("rank"), value(e).alias("value")))
        return rows.select("doc_id", F.filter(entries, lambda e: e["value"].isNotNull()).alias("entries"))
    joined = join_small(term_frequency(bags).select("doc_id", "rank", "tf"), idf, "rank", dictionary.rank_bytes)
    entry = F.struct("rank", (F.col("tf") * F.col("idf")).alias("value"))
    return joined.groupBy("doc_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def vector_rows(rows: DataFrame) -> DataFrame:
    """``(doc_id, rank, value)``, one row per entry."""
    return rows.select("doc_id", F.explode("entries").alias("e")).select("doc_id", "e.rank", "e.value")


def fit_transform(docs: DataFrame, size: int) -> tuple[TextModel, DataFrame]:
    """The model of ``docs`` and their own vectors ``(doc_id, entries)``.

    N counts all documents, also those without a known word. The bags serve both IDF and vectors, so
    they are stored once instead of being counted twice.
    """
    dictionary = fit_dictionary(docs, size)
    own = store(bags(docs, dictionary))
    idf = cut(inverse_document_frequency(document_frequency(own), dictionary.n_docs))
    return TextModel(dictionary, idf), tfidf(own, idf, dictionary)


def fit_text_model(docs: DataFrame, size: int) -> TextModel:
    """The model alone; the bags are counted on the fly."""
    dictionary = fit_dictionary(docs, size)
    frequency = document_frequency(bags(docs, dictionary))
    return TextModel(dictionary, cut(inverse_document_frequency(frequency, dictionary.n_docs)))


def non_zero_of(vectors: DataFrame, wanted: DataFrame) -> DataFrame:
    """The non-zero entries of the vectors whose ``doc_id`` is listed in ``wanted``."""
    return vectors.where("value <> 0").join(wanted.select("doc_id"), "doc_id", "left_semi")


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per rank; ``size`` ranks, 0 to ``size`` - 1."""

    table: DataFrame
    size: int
    shrink: float = 0.01


def feature_stats(rows: DataFrame, size: int) -> DataFrame:
    """``(rank, mean, std)`` over the documents in ``rows``, for all ranks below ``size``.

    A rank that a document lacks counts as 0. Mean and variance of the values present are combined
    with those of the zeros, which keeps the deviation of a constant feature at exactly 0; it is
    then set to 1.
    """
    n = rows.count()
    present = (
        rows.select(F.explode("entries").alias("e"))
        .groupBy("e.rank")
        .agg(F.count("*").alias("n"), F.avg("e.value").alias("avg"), F.var_pop("e.value").alias("var"))
    )
    share = F.col("n") / F.lit(float(n))
    variance = F.col("var") * share + F.col("avg") * F.col("avg") * share * (F.lit(1.0) - share)
    std = F.sqrt(variance)
    ranks = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("rank"))
    known = present.select("rank", (F.col("avg") * share).alias("mean"), std.alias("std"))
    return ranks.join(known, "rank", "left").select(
        "rank",
        F.coalesce("mean", F.lit(0.0)).alias("mean"),
        F.when(F.coalesce("std", F.lit(0.0)) == 0, 1.0).otherwise(F.col("std")).alias("std"),
    )


def fit_scaler(rows: DataFrame, size: int, shrink: float = 0.01) -> Scaler:
    return Scaler(cut(feature_stats(rows, size)), size, shrink)


def scaler_arrays(scaler: Scaler) -> Column:
    """``mean`` and ``std`` as arrays indexed by rank; the group behind it has one row per rank."""
    return _by_rank(scaler.table, scaler.size, "mean", "std")


def standardize(rows: DataFrame, scaler: Scaler, intercept: bool = False) -> DataFrame:
    """``(doc_id, rank, value)``: ((x - mean) / std) * shrink for every entry that exists.

    All documents that lack a rank share one value, which has a row of its own with a null
    ``doc_id``. With ``intercept``, so has one more feature of constant value ``shrink``.
    """

    def scaled(value: Column, mean: Column, std: Column) -> Column:
        return ((value - mean) / std * F.lit(scaler.shrink)).alias("value")

    if fits(scaler.size):
        of = lambda e: F.struct(e["rank"].alias("rank"), scaled(e["value"], F.get("s.mean", e["rank"]), F.get("s.std", e["rank"])))
        each = rows.withColumn("s", scaler_arrays(scaler)).select("doc_id", F.explode(F.transform("entries", of)).alias("e")).select("doc_id", "e.rank", "e.value")
    else:
        own = rows.select("doc_id", F.explode("entries").alias("e")).select("doc_id", "e.rank", "e.value")
        joined = join_small(own, scaler.table, "rank", scaler.size * RANK_ROW_BYTES)
        each = joined.select("doc_id", "rank", scaled(F.col("value"), F.col("mean"), F.col("std")))
    nobody = F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id")
    zero = (F.lit(0.0) - F.col("mean")) / F.col("std") * F.lit(scaler.shrink)
    cells = each.unionByName(scaler.table.select(nobody, "rank", zero.alias("value")))
    return add_intercept(cells, scaler.size, scaler.shrink) if intercept else cells


def add_intercept(cells: DataFrame, rank: int, value: float = 0.01) -> DataFrame:
    """One more feature that has the same value in every document."""
    nobody = F.lit(None).cast(cells.schema["doc_id"].dataType).alias("doc_id")
    row = cells.sparkSession.range(1).select(nobody, F.lit(rank).alias("rank"), F.lit(value).alias("value"))
    return cells.unionByName(row)
