from __future__ import annotations

import random
import re

import numpy as np
import pytest
from brambling.llm import jaccard_join as jj

SCHEMA = "doc_id long, text string, n long, rep string, gkey string"


def brute(rows, percent=85):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    first = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is None:
            continue
        comp[find(i)] = find(first.setdefault(doc_id, i))
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[j][0] is not None and both and 100 * both >= percent * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    low = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted(((r[0], len(s), low[find(i)] if r[0] is not None else None) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def planted(seed=1, hot=70):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "THE", "the"]
    make = lambda n: [rng.choice(words) for _ in range(n)]

    def edited(w, k):
        w = list(w)
        for _ in range(k):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        return w

    texts = [make(rng.randrange(1, 60)) for _ in range(60)]
    passage = make(40)
    texts += [make(30) + passage + make(30) for _ in range(30)]
    base = make(150)
    texts += [edited(base, rng.randrange(1, 4)) for _ in range(hot)]
    for n in (40, 80, 200, 400):
        one = make(n)
        texts += [edited(one, k) for k in range(8)] + [one[: int(n * x / 100)] for x in range(80, 100, 2)]
    chain = make(100)
    for i in range(10):
        chain = chain[3:] + make(3)
        texts.append(list(chain))
    texts += [["a"], ["a", "b"], ["a", "b"], ["b", "a"], ["a", "b", "c", "d"], ["a", "a", "a", "a", "a"], ["a", "a", "a", "a"]]
    rows = [(i, " \t".join(t), 1, "r", "g") for i, t in enumerate(texts)]
    rows += [(5000, None, 1, "r", "g"), (5001, "", 1, "r", "g"), (5002, " \n", 1, "r", "g"), (None, rows[3][1], 1, "r", "g"), (7, rows[7][1], 1, "r", "g"), (9, rows[70][1] + " more", 1, "r", "g")]
    rows += [(6000 + i, rows[65][1].upper(), 1, "r", "g") for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("frequent,block", [(32, 512), (3, 8)])
def test_against_brute_force(spark, monkeypatch, frequent, block):
    monkeypatch.setattr(jj, "FREQUENT", frequent)
    monkeypatch.setattr(jj, "BLOCK_ROWS", block)
    rows = planted(frequent)
    got = jj.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("block", [512, 7])
def test_many_texts_just_below_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(jj, "BLOCK_ROWS", block)
    rng = random.Random(block)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(80):
        text = list(base)
        for k in rng.sample(range(150), rng.choice([1, 2, 3, 3, 4, 5])):
            text[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text), 1, "r", "g"))
    loads = []
    load = jj._load
    monkeypatch.setattr(jj, "_load", lambda docs, members, width: loads.append(members) or load(docs, members, width))
    got = jj.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows) and 1 < len({r[2] for r in brute(rows)}) < 80
    last = loads[-1]
    assert last.where("ta = tb").count() > 0 and last.count() <= 80 * -(-80 // block) + 80


def test_keep_first(spark):
    rows = planted(5)
    df = spark.createDataFrame(rows, SCHEMA)
    kept = jj.keep_first(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in brute(rows) if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == want and len(ids) == len(want) + 1


def test_empty(spark):
    assert jj.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_frequent_shingles_with_a_gap_in_their_counts(spark, monkeypatch):
    monkeypatch.setattr(jj, "FREQUENT", 2)
    texts = ["one two three four"] * 40 + ["five six seven eight"] * 2 + [f"a b c d{i}" for i in range(9)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    assert len(jj.frequent_shingles(docs, 4)[0]) == 2
    monkeypatch.setattr(jj, "FREQUENT_MOST", 1)
    assert len(jj.frequent_shingles(docs, 4)[0]) == 1


@pytest.mark.parametrize("shingles", [4, 60])
def test_texts_longer_than_a_block(spark, monkeypatch, shingles):
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", shingles)
    rng = random.Random(shingles)
    rows = []
    for k in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(100)]
        for i in range(2 + k % 5):
            rows.append((10 * k + i, " ".join([*base, f"x{i}"]), 1, "r", "g"))
    loads, load = [], jj._load

    def counted(docs, members, width):
        loads.append(members)
        assert len(loads) < 10, "the groups do not get smaller"
        return load(docs, members, width)

    monkeypatch.setattr(jj, "_load", counted)
    got = jj.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows) and len({r[2] for r in brute(rows)}) == 12


def test_rows_that_share_an_id(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(3, two, 1, "r", "g"), (9, two, 1, "r", "g"), (9, one, 1, "r", "g"), (12, one, 1, "r", "g"), (20, three, 2, "r", "g"), (20, one + " x", 1, "r", "g"), (30, three, 1, "r", "g"), (12, "", 1, "r", "g"), (30, None, 1, "r", "g"), (35, "", 1, "r", "g")]
    rows += [(40, f"z{k} {three} {one} {two}" * (k % 3 + 1), k, "r", "g") for k in range(40, 0, -1)]
    got = jj.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    for parts in (1, 7):
        kept = jj.keep_first(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == [(3, two), (35, ""), (40, min(t for i, t, *_ in rows if i == 40))]


def family(n, seed=3):
    """Copies of one text with 4 of 150 words replaced each: most are just below the threshold of each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(n):
        text = list(base)
        for k in rng.sample(range(150), 4):
            text[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text), 1, "r", "g"))
    return rows


def test_a_family_of_near_copies_makes_no_pairs(spark, monkeypatch):
    sizes = {}
    for n in (40, 160):
        counted = sizes.setdefault(n, {})

        def wrapped(name, n=n, counted=counted, real=None):
            def run(*args):
                out = real(*args)
                counted[name] = counted.get(name, 0) + out.count()
                return out

            return run

        with monkeypatch.context() as patch:
            for name in ("_stars", "_opened", "_families"):
                patch.setattr(jj, name, wrapped(name, real=getattr(jj, name)))
            rows = family(n)
            got = jj.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert all(sizes[160][name] <= jj.KEYS * 160 for name in sizes[160])
    assert all(sizes[160][name] <= 5 * sizes[40][name] + 40 for name in sizes[160])


def test_least_first_is_sound():
    """Linked sets share at least ``least_first`` of the smaller one's number among their first shingles."""
    rng = random.Random(1)
    keys, powers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _ in range(300):
        n = rng.randrange(3, 400)
        base = [rng.getrandbits(64) for _ in range(n)]
        k = rng.randrange(0, n // 6 + 1)
        sets = [np.unique(np.array(base[k // 2 :] + [rng.getrandbits(64) for _ in range(rng.randrange(k // 2 + 1))], np.uint64)), np.unique(np.array(base[: n - k // 2], np.uint64))]
        both = len(np.intersect1d(*sets))
        if 100 * both < 85 * (len(sets[0]) + len(sets[1]) - both):
            continue
        firsts = [jj.first_shingles(s, keys, powers, 85)[0] for s in sets]
        small = min(map(len, sets))
        assert len(np.intersect1d(*firsts)) >= min(jj.least_first(small), jj.least_overlap(small, 85))


def test_family_keys_do_not_depend_on_blocks(monkeypatch):
    shingles = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    want = jj.family_keys(shingles).tolist()
    monkeypatch.setattr(jj, "KEY_BLOCK", 7)
    assert jj.family_keys(shingles).tolist() == want and len(set(want)) == jj.KEYS
