from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from brambling.llm import quality
from brambling.llm.common import fold
from brambling.llm.queries import op1_quality_classifier

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op1_quality_classifier(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels if rows[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([p == y for p, y in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(1)
    score, label = rng.random(40), rng.integers(0, 2, 40).astype(float)
    x, y = quality.isotonic(score, label)
    assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all()
    # The fit at a point is the largest mean from below of the smallest means from above.
    order = np.argsort(score)
    sorted_label = label[order]
    want = [max(min(sorted_label[i : j + 1].mean() for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    blocks = np.unique(np.round(want, 9))
    assert np.allclose(blocks, y)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.2), (3, "fine words here. " * 20_000, None), (None, "x", 0.3), (2, "", 0.2)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, F.lit(True))
    assert [r.s for r in quality.with_score(docs, model, ["doc_id"], "text", "s").collect()] == [0.5] * 5
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, None, 0), (3, 1, 0), (3, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, fold("doc_id", 4) >= 0)
    scores = [r.s for r in quality.with_score(docs, model, ["doc_id", "score"], "text", "s").collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert quality.with_score(docs.limit(0), model, ["doc_id"], "text", "s").count() == 0
