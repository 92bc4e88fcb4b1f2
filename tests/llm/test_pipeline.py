"""Each stage on the rows that its predecessor kept, against brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from brambling.llm import mixing
from brambling.llm.queries import op1_quality_classifier
from tests.llm import test_decontamination, test_jaccard_join, test_token_files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[1:5])


def test_quality(spark, outputs):
    want = {r.doc_id for r in op1_quality_classifier(spark, FOLDER).collect() if r.predicted}
    assert {r[0] for r in rows(outputs[1])} == want and 0 < len(want) < outputs[0].count()


def test_distinct(outputs):
    want = {component for _, _, component in test_jaccard_join.brute(rows(outputs[1]))}
    assert sorted(r[0] for r in rows(outputs[2])) == sorted(want)


def test_unseen(spark, outputs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = [r[0] for r in test_decontamination.brute(rows(outputs[2]), items) if not r[5]]
    assert sorted(r[0] for r in rows(outputs[3])) == sorted(want)


def test_mixed(outputs):
    copies = {r.doc_id: r.copies for r in mixing.mix(outputs[3]).collect() if r.copies}
    assert Counter(r[0] for r in rows(outputs[4])) == copies and max(copies.values()) <= 3


def test_encoded(outputs):
    got = sorted((tuple(r) for r in outputs[5].collect()), key=lambda r: r[1])
    assert got == test_token_files.brute(rows(outputs[4])) and pipeline.TOKENIZER == public_tokenizers.path("byte_bpe_50k.json")


def test_run(spark, outputs):
    assert sorted(map(str, pipeline.run(spark, FOLDER).collect())) == sorted(map(str, outputs[5].collect()))


def test_bad_rows_pass_through(spark, tmp_path):
    clashing = [f"{c} string" for c in ("_quality", "_text", "_found", "_key", "_cell", "_gone", "_id", "_y", "_row", "fold", "node", "rep")]
    schema = ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *clashing])
    words = " ".join(f"word{i}" for i in range(60))
    odd = [(1, None, None, None, None, "q"), (2, "", "en", "s", 0, "q"), (None, "no id " + words, None, "s", None, "q"), (3, words, "en", None, 9, "q"), (3, words, "en", None, 9, "q"), (4, "b " * 50_000, "en", "t", 1, "q")]
    for case in ([(*r[:5], *(f"{i}{c}" for c in clashing)) for i, r in enumerate(odd)], []):
        docs = first = spark.createDataFrame(case, schema)
        for _, stage in pipeline.STAGES[:4]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == first.columns
            assert docs.select(docs.columns[5:]).subtract(first.select(docs.columns[5:])).isEmpty()
        assert pipeline.STAGES[4][1](spark, docs, FOLDER).count() == docs.count()


def test_near_copies_are_those_of_operator_8(spark, monkeypatch):
    given = []
    monkeypatch.setattr(pipeline.jaccard_join, "keep_first", lambda docs, **options: given.append(options) or docs)
    pipeline.distinct(spark, spark.range(1), FOLDER)
    assert given == [{"width": 4, "percent": 85}]
