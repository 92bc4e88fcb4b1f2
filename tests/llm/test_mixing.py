from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction

import pytest

from brambling.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, _key string, size string"


def brute_targets(docs, epochs=3):
    size = defaultdict(int)
    for _, text, source, *_ in docs:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    clamped, total = set(), sum(size.values())
    while True:
        free = [s for s in order if s not in clamped]
        if not free:
            break
        level = Fraction(total - sum(epochs * size[s] for s in clamped), sum(weight[s] for s in free))
        more = {s for s in free if epochs * size[s] < level * weight[s]}
        if not more:
            break
        clamped |= more
    return size, {s: float(epochs * size[s] if s in clamped else level * weight[s]) for s in order}


DOCS = (
    [(i, "word " * (i % 17 + 1), "hot", 1, "x", "y") for i in range(900)]
    + [(1000 + i, "a\tb\x0bc d e", "small", 1, "x", "y") for i in range(20)]
    + [(2000 + i, "z " * 50, None, 1, "x", "y") for i in range(60)]
    + [(3000, None, "empty", None, None, None), (3001, "", "empty", 0, None, None), (None, "no id", "mid", 0, None, None)]
    + [(4000, "twice the same", "mid", 0, None, None)] * 2
    + [(5000, "w " * 5000, "one", 0, None, None)]
)


def test_targets_sizes_and_taken_words(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(DOCS)
    size, target = brute_targets(DOCS)
    source = {d[0]: d[2] for d in DOCS}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s], rel=1e-12)
        assert r.taken == r.size * r.copies <= 3 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in size:
        assert abs(taken[s] - target[s]) <= 2 * largest[s] + 1
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_repeat_keeps_columns_and_agrees_with_mix(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    mixed = mixing.repeat(docs)
    assert mixed.columns == docs.columns
    words = mixed.selectExpr(r"coalesce(sum(regexp_count(text, '[^\\x20\\x09-\\x0D]+')), 0)").first()[0]
    assert words == sum(r.taken for r in mixing.mix(docs).collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(docs).count() == 0 and mixing.repeat(docs).count() == 0
