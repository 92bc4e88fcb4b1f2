from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from brambling.llm import language
from brambling.llm.queries import op2_language_id

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op2_language_id(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()
    held = [(rows[d.doc_id].lang_pred, d.lang) for d in docs if rows[d.doc_id].held_out]
    assert len(rows) == len(docs) and len(held) > 100
    assert np.mean([p == y for p, y in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


TEXTS = {"aa": "the cat sat on the mat with another dog ", "bb": "der hund und die katze sitzen auf dem tisch "}


def training(spark):
    return spark.createDataFrame([(i, TEXTS[lang] * (i % 5 + 1), lang, 1) for i in range(20) for lang in TEXTS], "doc_id long, text string, lang string, score int")


def test_mixture_and_set(spark):
    model = language.fit(training(spark), F.lit(True))
    assert model.predict((TEXTS["aa"] * 30).encode())[::2] == ("aa", "aa:1.000")
    name, part, listed = model.predict((TEXTS["aa"] * 30 + TEXTS["bb"] * 70).encode())
    assert name == "bb" and 0.6 < part < 0.85 and listed.count(":") == 2


def test_one_round_of_em_by_hand():
    model = language.Languages(["x", "y"], np.tile([0.5, 0.25], (language.BUCKETS, 1)), np.array([0.5, 0.5]))
    table, weight = np.array([[0.8, 0.1], [0.2, 0.9]]), np.array([3.0, 1.0])
    part = np.array([0.5, 0.5])
    for _ in range(language.ROUNDS):
        r = table * part / (table @ part)[:, None]
        part = (weight @ r + 0.5 * language.PRIOR) / (weight.sum() + language.PRIOR)
    got, value = model._mixture(table, weight, np.array([0.5, 0.5]))
    assert np.allclose(got, part) and np.isclose(value, weight @ np.log(table @ part))


def test_edges(spark):
    rows = [(1, None, "aa", 0), (2, "", None, 0), (3, "12 !? 345", "aa", 0), (4, "é", None, 0), (None, "the mat", None, 0), (5, "the " * 100_000, None, 0), (5, "the " * 100_000, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = language.identify(docs, language.fit(training(spark), F.lit(True))).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and got[3].lang_pred in TEXTS and [r.lang_pred for r in got[4:]] == ["aa"] * 3
    nothing = language.fit(docs.limit(0), F.lit(True))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0), nothing).count() == 0


def brute(model, text):
    """Every size of the set is tried, over all languages."""
    counts = np.bincount(language.trigrams(text), minlength=language.BUCKETS).astype(float)
    seen = counts > 0
    weight, table, prior = counts[seen], model.likelihood[seen], np.maximum(model.share, 1e-6)
    every, _ = model._mixture(table, weight, prior)
    order, values = np.argsort(-every, kind="stable"), []
    alone = weight @ np.log(table)
    one = int(np.argmax(alone + np.log(model.share)))
    for size in range(1, len(order) + 1):
        members = order[:size] if size > 1 else np.array([one])
        part, value = model._mixture(table[:, members], weight, prior[members]) if size > 1 else (np.ones(1), float(alone[one]))
        values.append((value - language.PENALTY * np.log(weight.sum()) * size, members, part))
    best = max(range(len(values)), key=lambda k: values[k][0])
    _, members, part = values[best]
    at = int(np.argmax(part))
    return model.names[members[at]], float(every[members[at]]), ",".join(f"{model.names[k]}:{p:.3f}" for k, p in zip(members, part)), [v for v, *_ in values]


def mixed_models():
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    for n in [3, 4, 12, 14] * 12:
        base = rng.dirichlet(np.full(26, 0.4), n)
        base[1 : n - 2] = 0.8 * base[0] + 0.2 * base[1 : n - 2]
        text = lambda k, size: rng.choice(letters, size, p=base[k]).tobytes()
        names = [f"l{k:02d}" for k in range(n)]
        counts = {x: np.bincount(language.trigrams(text(k, 20_000)), minlength=language.BUCKETS) for k, x in enumerate(names)}
        model = language.Languages.of(counts, dict.fromkeys(names, 10))
        yield model, b" ".join([text(0, 1200), text(n - 1, int(rng.integers(60, 700))), text(n - 2, int(rng.integers(60, 700)))])


def test_all_languages_and_all_sizes():
    late = 0
    for model, text in mixed_models():
        name, score, listed, values = brute(model, text)
        assert model.predict(text) == (name, min(1.0, score), listed)
        late += any(v <= max(values[:k]) for k, v in enumerate(values[: int(np.argmax(values))]) if k)
    assert late
