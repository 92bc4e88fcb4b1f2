from __future__ import annotations

import dataclasses
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brambling import session
from brambling.functions.text import label_from_path, label_from_prefix
from brambling.operators import joins
from brambling.operators import text_features as tf
from brambling.sources.tagged import line_funnel, parse_documents, parse_lines, rejected_lines, tagged_line

DOCS = [
    ("AU1", "Court court, LAW the"),
    ("AU2", "the court 2nd appeal"),
    ("10", "the cat sat; the cat"),
    ("11", "The dog sat"),
    ("12", "99 !!"),
]
IDF = {0: 0.223144, 1: 0.916291, 2: 1.609438, 3: 0.916291}
TFIDF = {
    "AU1": {0: 0.074381, 1: 0.610860},
    "AU2": {0: 0.111572, 1: 0.458145},
    "10": {0: 0.089257, 2: 0.643775, 3: 0.183258},
    "11": {0: 0.111572, 3: 0.458145},
}
SCALED = {
    "AU1": [-0.014142, 0.012603, -0.005774, -0.008552, 0.01],
    "AU2": [0.009428, 0.007001, -0.005774, -0.008552, 0.01],
    "10": [-0.004714, -0.009802, 0.017321, 0.001222, 0.01],
    "11": [0.009428, -0.009802, -0.005774, 0.015882, 0.01],
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string")


@pytest.fixture(scope="module")
def fitted(docs):
    model, vectors = tf.fit_transform(docs, 4)
    rows = vectors.cache()
    return model, rows, tf.fit_scaler(rows, 4)


def nested(vectors):
    out: dict = {}
    for doc, rank, value in tf.vector_rows(vectors).collect():
        out.setdefault(doc, {})[rank] = round(value, 6)
    return out


def wide(cells, size):
    """Dense vectors from cells; those without an id hold for all documents that lack the rank."""
    shared, own = {}, {}
    for doc, rank, value in cells.collect():
        (shared if doc is None else own.setdefault(doc, {}))[rank] = round(value, 6)
    return {doc: [x.get(rank, shared[rank]) for rank in range(size)] for doc, x in own.items()}


def test_tokens(docs):
    words = dict(tf.tokenize(docs).collect())
    assert words["AU1"] == ["court", "court", "law", "the"]
    assert words["AU2"] == ["the", "court", "nd", "appeal"]
    assert words["12"] == []


TEXTS = st.lists(st.text(st.sampled_from("abZ éKİ9-_.\n\t"), max_size=30), min_size=1, max_size=8)


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_tokens_follow_their_definition(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = {i: re.sub("[^a-zA-Z]", " ", t).lower().split() for i, t in enumerate(texts)}
    assert dict(tf.tokenize(df).collect()) == want
    counted: dict = {}
    for found in want.values():
        for word in found:
            counted[word] = counted.get(word, 0) + 1
    assert dict(tf.word_counts(df).collect()) == counted


def test_dictionary(docs):
    rows = tf.fit_dictionary(docs, 4).table.collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == [("the", 0, 5), ("court", 1, 3), ("cat", 2, 2), ("sat", 3, 2)]


def test_dictionary_larger_than_the_vocabulary(docs):
    found = tf.fit_dictionary(docs, 100)
    assert found.size == 8 and found.nbytes > 0


def test_tfidf(fitted):
    model, vectors, _ = fitted
    assert {r: round(v, 6) for r, v in model.idf.collect()} == IDF
    assert nested(vectors) == TFIDF


def test_both_ways_to_fit_agree(docs, fitted):
    model, vectors, _ = fitted
    assert nested(tf.fit_text_model(docs, 4).transform(docs)) == nested(vectors)


def test_term_frequencies_add_up_to_one(docs):
    dictionary = tf.fit_dictionary(docs, 4)
    sums = tf.term_frequency(tf.bags(docs, dictionary)).groupBy("doc_id").agg(F.sum("tf"))
    assert all(math.isclose(total, 1) for _, total in sums.collect())


def test_a_dictionary_too_large_to_broadcast_gives_the_same_bag(docs):
    dictionary = tf.fit_dictionary(docs, 4)
    large = dataclasses.replace(dictionary, nbytes=joins.BROADCAST_BYTES + 1)
    near, far = tf.bag_of_words(docs, dictionary), tf.bag_of_words(docs, large)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.collect()))
    assert near.columns == far.columns


def test_more_texts_are_dealt_to_more_tasks(spark, docs, monkeypatch):
    dictionary = tf.fit_dictionary(docs, 4)
    bag = {tuple(r) for r in tf.bag_of_words(docs, dictionary).collect()}
    monkeypatch.setattr(tf, "TEXT_BYTES", 2)
    nbytes = sum(len(text) for _, text in DOCS)
    assert tf.text_parts(docs) == math.ceil(nbytes / 2) > 8
    dealt = tf.bag_of_words(docs, dictionary)
    assert f"hashpartitioning(doc_id#, {math.ceil(nbytes / 2)}), REPARTITION_BY_NUM" in re.sub(r"#\d+", "#", dealt._jdf.queryExecution().toString())
    assert {tuple(r) for r in dealt.collect()} == bag
    assert tf.text_parts(spark.createDataFrame([], "doc_id string, text string")) == 8


def test_repeated_ids_share_one_bag(spark, docs):
    dictionary = tf.fit_dictionary(docs, 4)
    twice = spark.createDataFrame([("x", "the the"), ("x", "the cat")], "doc_id string, text string")
    assert sorted(map(tuple, tf.bag_of_words(twice, dictionary).collect())) == [("x", 0, 3), ("x", 2, 1)]


def test_white_space_of_any_script_separates(spark, docs):
    dictionary = tf.fit_dictionary(docs, 4)
    text = "The\u00a0cat\u3000sat\u2003the\x1ccourt"
    query = spark.createDataFrame([("q", text)], "doc_id string, text string")
    want = [(0, 2), (1, 1), (2, 1), (3, 1)]
    for own in (dictionary, dataclasses.replace(dictionary, nbytes=joins.BROADCAST_BYTES + 1)):
        assert sorted(r[1:] for r in map(tuple, tf.bag_of_words(query, own, "whitespace").collect())) == want


def test_documents_move_once(docs):
    dictionary = tf.fit_dictionary(docs, 4)
    model = tf.fit_text_model(docs, 4)
    for df in (tf.bag_of_words(docs, dictionary), model.transform(docs), tf.fit_transform(docs, 4)[1]):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert plan.count("Exchange hashpartitioning(doc_id") <= 1 and "Window" not in plan
        # The dictionary is broadcast, documents are not.
        assert plan.count("Exchange") - plan.count("BroadcastExchange") <= 1


def test_null_texts_count_as_documents(spark):
    df = spark.createDataFrame([("a", "the cat"), ("b", None), ("c", "")], "doc_id string, text string")
    assert tf.fit_dictionary(df, 5).n_docs == 3
    assert [r.doc_id for r in tf.bags(df, tf.fit_dictionary(df, 5)).collect()] == ["a"]


def test_top_words_of_many_counts(spark):
    counts = [(f"w{i:05d}", i % 9000 + 1) for i in range(18_000)]
    order = sorted(counts, key=lambda x: (-x[1], x[0]))
    for rows in (counts, [*counts, (None, 7)]):
        df = spark.createDataFrame(rows, "word string, cnt bigint").repartition(6)
        for size in (0, 1, 3, 7000, 18_000, 20_000):
            found = [tuple(r) for r in tf.top_words(df, size).orderBy("rank").collect()]
            none = [(None, -1, 7)] if len(rows) > len(counts) else []
            assert found == none + [(w, k, n) for k, (w, n) in enumerate(order[:size])]


def test_the_vocabulary_is_not_written(spark, docs):
    """One job counts, keeps the top of each task and merges these."""
    plan = tf.texts_and_top_words(docs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Sort [" not in plan.split("TakeOrderedAndProject")[1] and "Python" not in plan


def test_words_are_counted_without_python(docs):
    dictionary = tf.fit_dictionary(docs, 4)
    for own in (dictionary, dataclasses.replace(dictionary, nbytes=joins.BROADCAST_BYTES + 1)):
        assert "Arrow" not in tf.bags(docs, own)._jdf.queryExecution().executedPlan().toString()


def test_small_tables_are_spread(spark, docs, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    assert session.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > one.rdd.getNumPartitions()


def test_whitespace_tokens_keep_punctuation(spark, docs):
    dictionary = tf.fit_dictionary(docs, 4)
    query = spark.createDataFrame([("q", "The cat, the\tCOURT")], "doc_id string, text string")
    assert sorted(r[1:] for r in map(tuple, tf.bag_of_words(query, dictionary, "whitespace").collect())) == [(0, 2), (1, 1)]
    with pytest.raises(ValueError):
        tf.bag_of_words(query, dictionary, "other")


def test_stats(fitted):
    _, _, scaler = fitted
    rows = {r: (round(m, 6), round(s, 6)) for r, m, s in scaler.table.collect()}
    assert rows == {0: (0.096696, 0.015779), 1: (0.267251, 0.272651), 2: (0.160944, 0.278763), 3: (0.160351, 0.187504)}


def test_standardized(fitted):
    _, rows, scaler = fitted
    assert wide(tf.standardize(rows, scaler, intercept=True), 5) == SCALED
    assert wide(tf.add_intercept(tf.standardize(rows, scaler), 4), 5) == SCALED
    assert tf.standardize(rows, scaler).count() == sum(map(len, TFIDF.values())) + 4


def test_a_word_in_every_document_is_standardized_to_zero(spark):
    docs = spark.createDataFrame([("a", "the cat"), ("b", "the dog"), ("c", "the")], "doc_id string, text string")
    rows = tf.fit_transform(docs, 3)[1].cache()
    scaler = tf.fit_scaler(rows, 3)
    assert tuple(scaler.table.where("rank = 0").first()) == (0, 0.0, 1.0)
    assert all(x[0] == 0 for x in wide(tf.standardize(rows, scaler), 3).values())


def test_new_documents_use_the_training_model(spark, fitted):
    model, *_ = fitted
    new = spark.createDataFrame([("n", "cat court zebra"), ("none", "zebra")], "doc_id string, text string")
    assert nested(model.transform(new)) == {"n": {1: round(0.916291 / 2, 6), 2: round(1.609438 / 2, 6)}}


def test_lookup_of_named_documents(spark, fitted):
    _, vectors, _ = fitted
    wanted = spark.createDataFrame([("10",), ("zzz",)], "doc_id string")
    found = tf.non_zero_of(tf.vector_rows(vectors), wanted).collect()
    assert {r: round(v, 6) for _, r, v in found} == TFIDF["10"] and {d for d, _, _ in found} == {"10"}


def test_tagged_lines(spark):
    lines = [
        '<doc id="20_newsgroups/sci.med/1" url="u" title="t"> a "> b </doc>',
        '<doc id="AU2" url=""> </doc>',
        "no document",
        '<doc id="3" url="u">',
        '<doc id="4">',
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [tuple(r) for r in parse_documents(df).collect()] == [("20_newsgroups/sci.med/1", 'a "> b'), ("AU2", "")]
    assert [tuple(r) for r in parse_documents(df, '">').collect()][0] == ("20_newsgroups/sci.med/1", ' a "> b')


def test_lines_without_a_document_are_counted(spark):
    lines = ['<doc id="1" url="u"> a </doc>', '<doc url="u"> a </doc>', '<doc id="2"> a </doc>', '<doc id="3" url="u" a </doc>', '<doc id="4" url="u"> a', "", None, "id="]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    want = [None, "no id", "no id", "no text mark", "no end tag", "no id", "no id", "no id"]
    assert [r.reason for r in parse_lines(df).collect()] == want
    assert [tuple(r) for r in rejected_lines(df).collect()] == [(line, why) for line, why in zip(lines, want) if why]
    assert [tuple(r) for r in line_funnel(df).collect()] == [(0, None, 0, 8), (1, "no id", 5, 3), (2, "no text mark", 1, 2), (3, "no end tag", 1, 1)]
    assert parse_documents(df).count() == 1 and [r.kept for r in line_funnel(df.where("false")).collect()] == [0] * 4


def test_documents_survive_the_tags(spark, docs):
    lines = docs.select(tagged_line(F.col("doc_id"), F.concat("text", F.lit("\nx"))).alias("value"))
    assert sorted(map(tuple, parse_documents(lines).collect())) == sorted((d, t + " x") for d, t in DOCS)


def test_labels(spark):
    df = spark.createDataFrame([("20_newsgroups/sci.med/59082",), ("AU35",)], "id string")
    row = df.select(label_from_path("id").alias("c"), label_from_prefix("id").alias("y")).collect()
    assert (row[0].c, row[0].y, row[1].y) == ("sci.med", 0, 1)
