from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from brambling.operators import categories, evaluation, forest, joins, tables


@pytest.fixture(params=["broadcast", "shuffle"])
def way(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    return request.param


VALUES = ["b", "a", "b", None, "c", "c", "d", "é", "", None, "hot", "hot", "hot"]


def test_categories_by_frequency_then_value(spark, way):
    df = spark.createDataFrame([(v, k) for k, v in enumerate(VALUES)], "value string, place int")
    index = categories.fit_index(df, "value")
    order = sorted(Counter(v for v in VALUES if v is not None).items(), key=lambda x: (-x[1], x[0].encode()))
    assert [(r.value, r.place, r.cnt) for r in index.table.orderBy("place").collect()] == [(v, k, n) for k, (v, n) in enumerate(order)]
    assert (index.size, index.unseen, index.missing, index.places) == (len(order), len(order), len(order) + 1, len(order) + 2)


def test_round_trip_with_unseen_and_null(spark, way):
    df = spark.createDataFrame([(v, k) for k, v in enumerate(VALUES)], "value string, place int")
    index = categories.fit_index(df, "value", least=2)
    placed = index.place_of(df, "value", "at")
    assert placed.columns == ["value", "place", "at"]
    found = {r.place: (r.value, r["at"], r.back) for r in index.value_of(placed, "at", "back").collect()}
    assert len(found) == len(VALUES)
    for value, at, back in found.values():
        kept = VALUES.count(value) >= 2 and value is not None
        assert back == (value if kept else None)
        assert at == index.missing if value is None else at == index.unseen if not kept else at < index.size


def test_index_of_numbers_and_empty_tables(spark):
    df = spark.createDataFrame([(2.0,), (float("nan"),), (float("nan"),), (-0.0,), (0.0,), (None,)], "x double")
    index = categories.fit_index(df, "x")
    got = Counter(r.p for r in index.place_of(df, "x", "p").collect())
    assert index.size == 3 and got == Counter({0: 2, 1: 2, 2: 1, index.missing: 1})
    none = categories.fit_index(df.where("false"), "x")
    assert none.size == 0 and {r.p for r in none.place_of(df, "x", "p").collect()} == {0, 1}


def test_ranked_over_many_partitions(spark):
    rows = [(random.Random(k).randrange(40), k) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = {(r.a, r.b): r.place for r in tables.ranked(df, [F.desc("a"), F.asc("b")], "place").collect()}
    assert got == {row: k for k, row in enumerate(sorted(rows, key=lambda x: (-x[0], x[1])))}


COLORS = [("red", 1, 0.5), ("blue", 2, None), ("red", 0, float("nan")), (None, 4, 0.0), ("green", 5, -1.5), ("blue", 1, 2.0), ("red", 1, 1.0)]


@pytest.mark.parametrize("drop_last", [False, True])
def test_entries_and_vectors_have_one_layout(spark, drop_last):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(COLORS)], "id int, color string, n int, x double")
    layout = categories.fit_layout(df.where("color <> 'green' or color is null"), ("n", "x"), ("color", "n"), drop_last)
    rows = layout.vectors(layout.entries(df)).withColumn("features", vector_to_array("features")).collect()
    assert len(rows) == len(COLORS) and layout.size == 2 + (2 + 2 - drop_last) + (4 + 2 - drop_last)
    for r in rows:
        dense = [0.0] * layout.size
        for e in r.entries:
            dense[e.rank] = e.value
        assert dense == r.features and [e.rank for e in r.entries] == sorted(e.rank for e in r.entries)
    places = {r.id: [e.rank for e in r.entries if 2 <= e.rank < 2 + 4 - drop_last] for r in rows}
    assert places[0] == places[2] == [2] and places[1] == [3] and places[4] == [4] and places[3] == ([] if drop_last else [5])
    described = {r.rank: (r.column, r.value) for r in layout.describe(df).collect()}
    assert set(described) == set(range(layout.size)) and described[1] == ("x", None) and described[2] == ("color", "red") and described[4] == ("color", "(unseen)")


def test_layout_without_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert categories.Layout().entries(df).first().entries == [] and categories.Layout().size == 0


def judged(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        label = rng.choice([0.0] * 6 + [1.0, 2.0, 3.0, 5.0])
        rows.append((label, label if rng.random() < 0.6 else rng.choice([0.0, 1.0, 2.0, 4.0])))
    return spark.createDataFrame(rows, "label double, prediction double")


def test_measures_are_those_of_spark(spark):
    df = judged(spark)
    measures = evaluation.class_measures(evaluation.confusion_cells(df))
    got = evaluation.summary(measures).first()
    ask = lambda name, **kw: MulticlassClassificationEvaluator(metricName=name, **kw).evaluate(df)
    pairs = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "weighted_f": "f1", "weighted_fpr": "weightedFalsePositiveRate", "hamming_loss": "hammingLoss"}
    assert all(math.isclose(got[own], ask(theirs), abs_tol=1e-12) for own, theirs in pairs.items())
    for r in measures.where("support > 0").collect():
        for own, theirs in (("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f", "fMeasureByLabel"), ("fpr", "falsePositiveRateByLabel")):
            assert math.isclose(r[own] or 0.0, ask(theirs, metricLabel=r["class"]), abs_tol=1e-12)
    half = evaluation.class_measures(evaluation.confusion_cells(df), beta=0.5)
    assert math.isclose(half.where("class = 1").first().f, ask("fMeasureByLabel", metricLabel=1.0, beta=0.5), abs_tol=1e-12)


def test_confusion_with_nulls(spark):
    rows = [("a", "a"), ("a", "b"), ("b", None), (None, "a"), ("c", "a"), ("a", "a"), ("b", "z")]
    df = spark.createDataFrame(rows, "actual string, guess string")
    cells = evaluation.confusion_cells(df, "actual", "guess")
    table = {(r.label, r.prediction): r.n for r in evaluation.confusion_table(cells).collect()}
    want = {(x, y): 0 for x in "abcz" for y in "abcz"} | {("a", "a"): 2, ("a", "b"): 1, ("b", None): 1, ("c", "a"): 1, ("b", "z"): 1}
    assert table == want
    by = {r["class"]: r for r in evaluation.class_measures(cells).collect()}
    assert (by["a"].support, by["a"].predicted, by["a"].tp, by["a"].fp, by["a"].fn) == (3, 3, 2, 1, 1)
    assert by["c"].precision is None and by["c"].recall == 0 and by["z"].recall is None and by["z"].support == 0 and by["b"].f == 0
    row = evaluation.summary(evaluation.class_measures(cells)).first()
    assert (row.classes, row.rows, row.accuracy) == (4, 6, 2 / 6)


def test_measures_of_nothing(spark):
    cells = evaluation.confusion_cells(spark.createDataFrame([], "label string, prediction string"))
    assert evaluation.confusion_table(cells).count() == 0
    row = evaluation.summary(evaluation.class_measures(cells)).first()
    assert row.classes == 0 and row.accuracy is None and row.macro_f is None


def test_log_loss(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [1.0, 0.0]), (5, [0.2, 0.8]), (None, [1.0, 0.0]), (0, None)], "p int, q array<double>")
    want = -(math.log(0.5) + 2 * math.log(1e-15)) / 3
    assert math.isclose(evaluation.log_loss(df, "p", "q").first().log_loss, want)


def shapes(n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        kind = rng.choice(["cat", "cat", "dog", "owl"])
        size = {"cat": 1.0, "dog": 5.0, "owl": 1.2}[kind] + rng.gauss(0, 0.3)
        rows.append((k, kind if rng.random() > 0.05 else None, size if rng.random() > 0.02 else None, "feather" if kind == "owl" else rng.choice(["fur", None])))
    return rows


def test_forest_classifier(spark):
    df = spark.createDataFrame(shapes(), "id int, kind string, size double, coat string").coalesce(1)
    model = forest.ForestClassifier.fit(df, "kind", ["size"], ["coat"], trees=7, depth=4)
    unknown = spark.createDataFrame([(1000, None, 1.1, "feather"), (1001, None, 5.2, "scales"), (1002, None, None, None)], df.schema)
    rows = model.predict(df.unionByName(unknown)).collect()
    assert len(rows) == 303 and model.trees == 7 and model.classes.size == 3
    known = [r for r in rows if r.kind is not None]
    assert sum(r.prediction == r.kind for r in known) > 0.95 * len(known)
    by_id = {r.id: r.prediction for r in rows}
    assert by_id[1000] == "owl" and by_id[1001] == "dog" and by_id[1002] is not None
    names = {r.place: r.value for r in model.classes.table.collect()}
    for r in rows:
        assert math.isclose(sum(r.probabilities), 1) and sum(r.votes) == 7
        assert r.prediction == names[max(range(3), key=lambda k: r.probabilities[k])]


def test_votes_are_those_of_the_trees(spark):
    df = spark.createDataFrame(shapes(120), "id int, kind string, size double, coat string").coalesce(1)
    model = forest.ForestClassifier.fit(df, "kind", ["size"], ["coat"], trees=5)
    got = {r.id: r.votes for r in model.scores(df).collect()}
    vectors = {r.id: r.f for r in model.layout.vectors(df, "f").collect()}
    for k, vector in vectors.items():
        cast = Counter(int(tree.predict(vector)) for tree in model.forest.trees)
        assert got[k] == [cast[c] for c in range(3)]


def test_forest_needs_two_classes(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "kind string, size double")
    with pytest.raises(ValueError):
        forest.ForestClassifier.fit(df, "kind", ["size"])
