from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from brambling.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, id long"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain integers, one vector after another."""
    kept = [(r[0], r[1], r[2]) for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(min(max(np.float32(x).item() * 256, -(2**22)), 2**22)) for x in v], label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    d = len(kept[0][1])
    cuts = [k * (d // parts) + min(k, d % parts) for k in range(parts + 1)]
    same = [r for r in kept if len(r[1]) == d]
    books = [[r[1][a:b] for r in same[:entries]] for a, b in zip(cuts, cuts[1:])]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            members = {}
            for r in same:
                members.setdefault(near(r[1][a:b], books[p])[1], []).append(r[1][a:b])
            for k, own in members.items():
                books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, label in kept:
        if len(v) != d:
            out.append((i, label, None, None))
            continue
        found = [near(v[a:b], books[p]) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found)))
        by_label[label] = by_label.get(label, 0) + out[-1][3]
    return [(i, code, error, None if error is None else by_label[label], digest) for i, label, code, error in out]


def planted(seed=2, n=120, d=37, scale=0.3):
    rng = np.random.default_rng(seed)
    vector = lambda: (rng.standard_normal(d) * scale).astype(np.float32).tolist()
    rows = [(int(i), vector(), int(rng.integers(0, 3)), "", 0) for i in rng.permutation(n)]
    same = vector()
    rows += [(1000 + i, same, 7, "", 0) for i in range(60)] + [(3, vector(), None, "", 0), (3, rows[0][1], None, "", 0), (5, vector(), 7, "", 1), (None, vector(), 1, "", 0)]
    rows += [(-9, None, 0, "", 0), (-8, [float("nan")] + same[1:], 0, "", 0), (-7, [None] + same[1:], 0, "", 0), (-6, [float("-inf")] * d, 0, "", 0)]
    return rows + [(500, [0.0] * d, 2, "", 0), (501, [], 2, "", 0), (502, same[:-1], 2, "", 0), (503, [1e30, -1e30] + same[2:], 2, "", 0)]


def tuples(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize(("d", "scale"), [(37, 0.3), (16, 3000.0), (10, 0.01)])
def test_against_brute_force(spark, monkeypatch, d, scale):
    monkeypatch.setattr(vc, "RESIDENT", 40)
    rows = planted(d=d, scale=scale)
    got = tuples(vc.encode(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    want = sorted(brute(rows), key=str)
    assert got == want and len(want) == len(rows) - 4 and sum(w[1] is None for w in want) == 2


def test_more_rounds_and_few_vectors(spark):
    rows = planted(n=30)[:30]
    assert tuples(vc.encode(spark.createDataFrame(rows, SCHEMA), entries=5, rounds=4)) == sorted(brute(rows, entries=5, rounds=4), key=str)
    assert tuples(vc.encode(spark.createDataFrame(rows[:1], SCHEMA))) == brute(rows[:1])


def test_empty(spark):
    assert vc.encode(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = [(1, [], 2, "", 0), (2, [], 2, "", 0)]
    assert tuples(vc.encode(spark.createDataFrame(empty, SCHEMA))) == sorted(brute(empty), key=str)


def test_only_members_that_change_entry_move(spark):
    df = spark.createDataFrame([(0, 0, 1, 0, [1], 1, 0), (1, 0, 1, 0, [9], 2, 4)], f"{vc._MEMBER}, nearest int, error long")
    assert [(r.id, r.entry) for r in vc.moved(df).collect()] == [(1, 2)]


def test_nearest_is_exact_for_large_components():
    rng = np.random.default_rng(0)
    parts, book = (rng.integers(-(2**22), 2**22, (n, 4)) for n in (50, 20))
    entry, distance = vc.nearest(parts, book)
    for row, e, far in zip(parts.tolist(), entry, distance):
        every = [sum((x - y) ** 2 for x, y in zip(row, b)) for b in book.tolist()]
        assert far == min(every) and e == every.index(min(every))
