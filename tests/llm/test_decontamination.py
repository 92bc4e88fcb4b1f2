from __future__ import annotations

import hashlib
import pickle
import random
import re

import numpy as np

from brambling.llm import decontamination as dc

DOCS = "doc_id long, text string, words long, _x string"
ITEMS = "item_id long, text string, item string"


def brute(docs, items, width=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text, *_ in items:
        w = cut(text)
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = cut(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def planted(seed=3):
    rng = random.Random(seed)
    words = ["a", "b", "the", "of", "Éa", "x1", "dog", "CAT", "é"] + [f"w{i}" for i in range(40)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, make(rng.choice([5, 13, 14, 30, 60])), "z") for i in range(25)] + [(100, items_text := make(20), "z"), (101, items_text, "z"), (102, "", "z"), (103, None, "z")]
    items += [(None, make(20), "z"), (104, "only", "z"), (105, "a " * 30, None), (105, make(15), None)]
    docs = []
    for i in range(120):
        text = make(rng.randrange(1, 200))
        for _ in range(rng.randrange(3)):
            piece = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, max(1, len(piece) - 13))
            text += ", " + "; ".join(piece[a : a + rng.choice([12, 13, 20])]) + ". " + make(rng.randrange(30))
        docs.append((i, text, None, "y"))
    docs += [(500, None, 1, "y"), (501, "", 1, "y"), (502, "...", 1, "y"), (None, items[0][1], 1, "y"), (503, "a " * 3000, 1, "y"), (504, items[1][1], 1, "y"), (504, items[1][1], 1, "y")]
    docs += [(505, make(40_000) + " " + items[2][1].upper(), 1, "y")]
    return docs, items


def run(spark, docs, items):
    found = dc.find(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), ["doc_id"])
    return sorted((tuple(r) for r in dc.digest(found).collect()), key=str)


def test_against_brute_force(spark):
    docs, items = planted()
    got = run(spark, docs, items)
    assert got == brute(docs, items) and any(r[5] for r in got)


def test_several_blocks_of_items_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(dc, "ITEM_BYTES", 1000)
    monkeypatch.setattr(dc, "SHARD_BYTES", 500)
    monkeypatch.setattr(dc, "PIECE_BYTES", 64)
    docs, items = planted(4)
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = planted(5)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_clean_documents_stay_whole(spark):
    docs, items = planted(6)
    df = spark.createDataFrame(docs, DOCS)
    clean = dc.keep_clean(df, spark.createDataFrame(items, ITEMS))
    assert clean.columns == df.columns
    bad = sum(r[5] for r in brute(docs, items))
    assert clean.count() == len(docs) - bad and bad


def test_ranks_against_counting():
    rng = np.random.default_rng(1)
    sequence = rng.integers(0, 9, 300)
    wavelet = dc.Wavelet(sequence, 8)
    for symbol in range(9):
        places = np.arange(301)
        want = np.concatenate([[0], np.cumsum(sequence == symbol)])
        assert (wavelet.rank(np.full(301, symbol), places) == want).all()


def test_a_plan_holds_one_block_of_items(spark, monkeypatch):
    monkeypatch.setattr(dc, "ITEM_BYTES", 1000)
    alive, of = [], dc.Windows.of

    def counted(items, width):
        alive.append(items)
        return of(items, width)

    monkeypatch.setattr(dc.Windows, "of", counted)
    docs, items = planted(7)
    found = dc.find(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), ["doc_id"])
    assert len(alive) > 2 and found._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    assert sorted((tuple(r) for r in dc.digest(found).collect()), key=str) == brute(docs, items)


def test_what_travels_is_about_the_size_of_the_items():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(5000)]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.randrange(200))).encode()) for i in range(2000)]
    windows = dc.Windows.of(items, 13)
    assert len(pickle.dumps(windows)) <= 3.2 * sum(len(text) for _, text in items)
    number, want = windows.vocabulary(), {}
    for item, text in items:
        ids = [number[w] for w in text.split()]
        for i in range(max(1, len(ids) - 12) if ids else 0):
            want.setdefault(tuple(ids[i : i + 13]), set()).add(item)
    own = {tuple(windows.words[a : a + n].tolist()): set(windows.items(k)) for k, (a, n) in enumerate(zip(windows.first, windows.length))}
    assert own == want and len(windows.first) == len(want)
