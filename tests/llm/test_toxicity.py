from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from brambling.llm import quality, toxicity
from brambling.llm.queries import op4_toxicity

FOLDER = "/root/testdata/sf0.1"


def area(score, y):
    """The share of pairs of a positive and a negative in the right order, ties counting half."""
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(order))
    _, back, number = np.unique(score[order], return_inverse=True, return_counts=True)
    ranks[order] = (np.cumsum(number) - (number - 1) / 2)[back]
    positive = y == 1
    return (ranks[positive].sum() - positive.sum() * (positive.sum() + 1) / 2) / (positive.sum() * (~positive).sum())


def test_area():
    assert area(np.array([0.1, 0.5, 0.5, 0.9]), np.array([0, 0, 1, 1])) == 3.5 / 4


def test_held_out_labels(spark):
    """By measures that a constant score fails: most labels are 0."""
    rows = {r.doc_id: r for r in op4_toxicity(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic is not null").collect()
    held = np.array([(rows[r.doc_id].score, rows[r.doc_id].predicted, r.toxic) for r in labels if rows[r.doc_id].held_out])
    score, predicted, y = held.T
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert area(score, y) >= 0.93
    assert predicted[y == 1].mean() >= 0.85 and y[predicted == 1].mean() >= 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def small():
    rng = np.random.default_rng(3)
    bad = [rng.integers(0, 40, 30) for _ in range(30)]
    for d in bad:
        d[rng.integers(0, 30)] = 50
    good = [rng.integers(0, 40, 30) for _ in range(60)]
    docs = [np.asarray(d) * (toxicity.BUCKETS + 1) for d in bad + good]
    return docs, np.array([1.0] * 30 + [0.0] * 60)


def test_training_separates_by_one_word():
    docs, y = small()
    net = toxicity.train(docs, y)
    logits = net.logits(docs)
    assert logits[:30].min() > logits[30:].max()
    assert np.allclose(net.logits(docs[:1] + [np.zeros(0, np.int64)])[0], logits[0])


def test_gradient_against_differences():
    docs, y = small()
    net = toxicity.train(docs[20:40], y[20:40])
    loss = lambda: float(np.mean(np.log1p(np.exp(net.logits(docs))) - y * net.logits(docs)))
    seen = {}
    net._descend = lambda name, value, gradient, rows=slice(None): seen.setdefault(name, (value, gradient, rows))
    base = net.base
    net.step(docs, y, np.ones(len(y)))
    net.base = base
    for name, at in (("out", (3,)), ("bias", (0,)), ("filters0", (0, 0, 0)), ("filters1", (1, 0, 2)), ("filters2", (2, 1, 1))):
        value, gradient, _ = seen[name]
        old = value[at]
        value[at] = old + 1e-6
        up = loss()
        value[at] = old - 1e-6
        assert np.isclose((up - loss()) / 2e-6, gradient[at], atol=1e-5)
        value[at] = old


def test_threshold():
    assert toxicity.threshold(np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])) == 0.55
    # Three above have F1 0.8, one has 0.67; equal scores are not parted.
    assert toxicity.threshold(np.array([0.9, 0.5, 0.5, 0.2]), np.array([1, 1, 0, 0])) == 0.35


def test_all_labels_are_learned_from(spark):
    """Each of 60 bad words is in a few documents only: a sample of the labels knows few of them."""
    rng = np.random.default_rng(5)
    plain = [f"plain{k}" for k in range(80)]
    rows = []
    for i in range(3000):
        words = list(rng.choice(plain, 20))
        if i % 5 == 0:
            words[rng.integers(0, 20)] = f"{'zyxwvu'[i // 5 % 6]}bad{i // 5 % 60}"
        rows.append((i, " ".join(words), "en", int(i % 5 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(3)
    new = [(i, f"plain1 plain2 {'zyxwvu'[i % 6]}bad{i} plain3", 1) for i in range(60)] + [(100 + i, " ".join(plain[i : i + 20]), 0) for i in range(40)]
    asked = spark.createDataFrame(new, "doc_id long, text string, toxic int")
    scores = []
    for parts in (3, 7):
        model = toxicity.fit(table.repartition(parts), table.select("doc_id", "toxic"), F.lit(True), "toxic", "doc_id", "text", "lang", 120)
        rows = quality.with_score(asked, model, ["doc_id", "toxic"], "text", "score").orderBy("doc_id").collect()
        scores.append([r.score for r in rows])
    right = [(r.score >= 0.5) == (r.toxic == 1) for r in rows]
    assert np.mean(right[:60]) >= 0.95 and np.mean(right[60:]) >= 0.95
    # How the rows lie in partitions does not matter, nor the order of sums.
    assert scores[0] == scores[1]


def test_what_a_shard_moved_is_put_back():
    docs, y = small()
    first = toxicity.begin(toxicity.presence(docs[:50], y[:50]) + toxicity.presence(docs[50:], y[50:]), len(docs), float(y.sum()))
    alone, copied = (toxicity.begin(toxicity.presence(docs, y), len(docs), float(y.sum())) for _ in range(2))
    assert np.array_equal(first.words, alone.words) and np.array_equal(first.prefixes, alone.prefixes) and first.base == alone.base
    alone.learn(docs, y, 3, np.random.default_rng(0))
    keys, weights, rows = alone.changes(len(docs))
    turn = np.random.default_rng(1).permutation(len(keys))
    copied.put(keys[turn], rows[turn])
    assert len(set(keys)) == len(keys) and weights.min() > 0 and weights[-1] == len(docs)
    assert np.array_equal(copied.logits(docs), alone.logits(docs)) and not np.array_equal(first.logits(docs), alone.logits(docs))
    for name in ("filters0", "filters2", "bias", "out"):
        assert np.array_equal(copied.squares[name], alone.squares[name])


def test_threshold_of_counted_scores():
    score, y = np.array([0.9, 0.5, 0.5, 0.2]), np.array([1, 1, 0, 0])
    assert toxicity.threshold(np.array([0.9, 0.5, 0.2]), np.array([1, 1, 0]), np.array([1, 2, 1])) == toxicity.threshold(score, y)


def test_edges(spark):
    rows = [(1, None, None, 0.0), (2, "", "en", 0.0), (3, "fine words " * 50_000, "en", 0.0), (None, "x", "en", 0.0), (2, "", "en", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = lambda m, d=docs: [r.s for r in quality.with_score(d, m, ["doc_id"], "text", "s").collect()]
    assert scores(toxicity.fit(docs, none, F.lit(True))) == [0.0] * 5
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (2, 0, 1), (3, 1, 0), (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert all(0 <= s <= 1 for s in scores(model)) and scores(model, docs.limit(0)) == []
