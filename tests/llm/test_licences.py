from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from brambling.llm import licences as lc

SCHEMA = "doc_id long, text string, found string, number long"


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows):
    """Every place of every text is compared with every phrase."""
    known, files = lc.notices(), [words_of(r[1]) for r in rows]
    weight = lambda w: math.log((len(rows) + 1) / (sum(w in f for f in files) + 1)) + 1
    weights = {w: weight(w) for n in known for w in n.words}
    out = []
    for (doc_id, *_), words in zip(rows, files):
        stands = lambda key: [i for i in range(len(words)) if words[i : i + len(key)] == key]
        base, labels, score = [], set(), 0.0
        for n in known:
            for i in stands(n.keys[0]):
                if any(not any(abs(o - i - at + n.at[0]) <= lc.SLACK for o in stands(key)) for key, at in zip(n.keys[1:], n.at[1:])):
                    continue
                labels.add(n.label)
                if n.base:
                    base.append((i, n.label))
                begin = i - n.at[0]
                same = sum(weights[w] for k, w in enumerate(n.words) if 0 <= begin + k < len(words) and words[begin + k] == w)
                score = max(score, 1.0 if n.base else round(same / sum(weights[w] for w in n.words), lc.DIGITS))
        first, last = (min(base)[0], max(base)[0]) if base else (None, None)
        out.append((doc_id, len(words), len(base), first, last, ",".join(sorted({b[1] for b in base})), ",".join(sorted(labels)), score))
    return out


def texts():
    rng = random.Random(4)
    phrases = [" ".join(n.words) for n in lc.notices()] + [" ".join(k) for n in lc.notices() for k in n.keys]
    out = [None, "", "!!", "CC-BY", "cc\nby", "cc  By-NC 4.0", "ccby", "cc é by", "general public licence", "All rights reserved.", "cc by cc by cc by", "by cc", "cc"]
    out += ["GENERAL PUBLIC LICENSE general public license", "alſo all rights reserved", "all rightsé reserved", "mit\x7flicense", "cc by" * 3, "x" * 500_000, "license " * 20_000 + "mit license"]
    for _ in range(60):
        own = []
        for _ in range(rng.randrange(1, 5)):
            own += ["filler"] * rng.randrange(3) + rng.choice(phrases).split()
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = rng.choice(["license", "the", "Ünfug", ""])
            if rng.random() < 0.3:
                del own[rng.randrange(len(own))]
        out.append(rng.choice([" ", "\n", "-", ", "]).join(w.upper() if rng.random() < 0.3 else w for w in own))
    return out


def tuples(df):
    got = df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("run", [lc.RUN_BYTES, 200])
def test_against_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(lc, "RUN_BYTES", run)
    monkeypatch.setattr(lc, "CHUNK", 3)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())]
    rows += [(None, "cc by", "", 0), (3, "cc by", "", 0), (3, "cc by", "", 0)]
    got, want = tuples(lc.digest(lc.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)))), sorted(brute(rows), key=str)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert all(abs(g[-1] - w[-1]) < 1e-8 for g, w in zip(got, want))
    assert {x for w in want for x in w[6].split(",")} >= {"mit", "bsd", "gpl", "cc-by", "reserved", "apache-2.0"} and any(0 < w[-1] < 1 for w in want)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got, want = tuples(lc.digest(lc.scan(docs))), sorted(brute(rows), key=str)
    assert [g[:-1] for g in got] == [w[:-1] for w in want] and any(w[2] for w in want)


def test_key_phrases_apart(spark):
    mit = next(n for n in lc.notices() if len(n.keys) > 1)
    found = [k for gap in (0, lc.SLACK, lc.SLACK + 1) for k in [mit.keys[0] + ["x"] * (mit.at[1] - len(mit.keys[0]) + gap) + mit.keys[1]]]
    rows = [(i, " ".join(words), "", 0) for i, words in enumerate(found)]
    assert [r.labels for r in lc.digest(lc.scan(spark.createDataFrame(rows, SCHEMA))).orderBy("doc_id").collect()] == ["mit", "mit", ""]


def test_empty_table(spark):
    assert lc.digest(lc.scan(spark.createDataFrame([], SCHEMA))).count() == 0


def test_index_takes_the_rarest_words():
    assert lc.rarest(np.array([0, 1, 2, 1]), np.array([0.5, 2.0, 1.0]), 3).tolist() == [1, 3, 2]


def test_own_notices(spark):
    with pytest.raises(ValueError):
        lc.notices(others=(("x", "one two", ("two one",)),))
    known = lc.notices(base=(("a", "ab abcdefghi"), ("b", "abcdefghij")), others=())
    rows = [(0, "ab abcdefghi abcdefghij abcdefgh", "", 0)]
    assert [r.labels for r in lc.digest(lc.scan(spark.createDataFrame(rows, SCHEMA), known=known)).collect()] == ["a,b"]
