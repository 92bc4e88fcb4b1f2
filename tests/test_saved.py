from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import pytest

from brambling.operators import categories, forest, logistic, neighbours, saved
from brambling.operators import text_features as tf
from brambling.session import store

DOCS = [(f"docs/{'en' if k % 3 else 'xx'}/{k}", " ".join(f"w{'abcdefghij'[(k * j) % 10]}" for j in range(1, 12)) + (" the" if k % 3 else " le")) for k in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string")


def fit(docs):
    model, vectors = tf.fit_transform(docs, 30)
    rows = store(vectors.withColumn("y", vectors.doc_id.startswith("docs/en").cast("int")))
    return model, rows, logistic.fit_logistic(rows, tf.fit_scaler(rows, model.dictionary.size))


def test_models_predict_the_same_bits(spark, docs, tmp_path):
    model, rows, descent = fit(docs)
    saved.save(model, f"{tmp_path}/text")
    saved.save(descent, f"{tmp_path}/descent")
    text, again = saved.load(spark, f"{tmp_path}/text", tf.TextModel), saved.load(spark, f"{tmp_path}/descent")
    assert (again.theta == descent.theta).all() and (again.loss, again.iterations, again.rejected) == (descent.loss, descent.iterations, descent.rejected)
    own = {r.doc_id: (r.z, r.prediction) for r in descent.predict(model.transform(docs)).collect()}
    loaded = {r.doc_id: (r.z, r.prediction) for r in again.predict(text.transform(docs)).collect()}
    assert own == loaded and len(own) == len(DOCS)


def test_another_session_predicts_the_same_bits(spark, docs, tmp_path):
    model, _, descent = fit(docs)
    saved.save(model, f"{tmp_path}/text")
    saved.save(descent, f"{tmp_path}/descent")
    own = {r.doc_id: r.z.hex() for r in descent.predict(model.transform(docs)).collect()}
    docs.write.parquet(f"{tmp_path}/docs")
    script = f"""
import json
from brambling.operators import saved
from brambling.session import local_session
spark = local_session(2, "second")
text, descent = saved.load(spark, {str(tmp_path / "text")!r}), saved.load(spark, {str(tmp_path / "descent")!r})
rows = descent.predict(text.transform(spark.read.parquet({str(tmp_path / "docs")!r}))).collect()
print("RESULT" + json.dumps({{r.doc_id: r.z.hex() for r in rows}}))
"""
    run = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=Path(__file__).parents[1], timeout=300)
    (line,) = [x for x in run.stdout.splitlines() if x.startswith("RESULT")]
    assert json.loads(line.removeprefix("RESULT")) == own


def test_text_classifier(spark, docs, tmp_path):
    model = neighbours.TextClassifier.fit(docs, 30)
    saved.save(model, f"{tmp_path}/knn")
    again = saved.load(spark, f"{tmp_path}/knn", neighbours.TextClassifier)
    asked = docs.limit(7)
    assert sorted(map(tuple, model.predict(asked, 3).collect())) == sorted(map(tuple, again.predict(asked, 3).collect()))


def test_layout_and_forest(spark, tmp_path):
    rows = [(k, "ab"[k % 2], float(k % 2) + k / 100, ["x", "y", None][k % 3]) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, kind string, size double, place string")
    model = forest.ForestClassifier.fit(df, "kind", ["size"], ["place"], trees=3)
    saved.save(model, f"{tmp_path}/forest")
    again = saved.load(spark, f"{tmp_path}/forest", forest.ForestClassifier)
    assert model.predict(df).orderBy("id").collect() == again.predict(df).orderBy("id").collect()
    layout = categories.fit_layout(df, ("size",), ("place", "kind"), drop_last=True)
    saved.save(layout, f"{tmp_path}/layout")
    back = saved.load(spark, f"{tmp_path}/layout")
    assert layout.entries(df).orderBy("id").collect() == back.entries(df).orderBy("id").collect() and back.size == layout.size


def test_what_cannot_be_saved_or_loaded(spark, docs, tmp_path):
    with pytest.raises(TypeError):
        saved.save(3, f"{tmp_path}/three")
    words = tf.fit_dictionary(docs, 5)
    saved.save(words, f"{tmp_path}/words")
    assert saved.load(spark, f"{tmp_path}/words").n_docs == len(DOCS)
    with pytest.raises(TypeError):
        saved.load(spark, f"{tmp_path}/words", tf.Scaler)
    with pytest.raises(Exception, match="exist"):
        saved.save(words, f"{tmp_path}/words")
    manifest = json.loads(spark.read.text(f"{tmp_path}/words/manifest").first().value) | {"layout": 99}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").write.mode("overwrite").text(f"{tmp_path}/words/manifest")
    with pytest.raises(ValueError):
        saved.load(spark, f"{tmp_path}/words")
