from __future__ import annotations

import numpy as np
import pytest

from brambling.llm import components
from brambling.llm import near_vectors as nv
from brambling.llm.components import connected

SCHEMA = "vec_id long, embedding array<float>, label int, n long"


def brute(rows):
    good = []
    for i, (vec_id, v, *_) in enumerate(rows):
        ok = vec_id is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        good.append(ok)
    links = [0] * len(rows)
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if not (good[i] and good[j]) or len(rows[i][1]) != len(rows[j][1]):
                continue
            a, b = (np.float32(rows[k][1]).astype(np.float64) for k in (i, j))
            if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95:
                links[i] += 1
                links[j] += 1
                comp[find(i)] = find(j)
    low = {}
    for i, (vec_id, *_) in enumerate(rows):
        if vec_id is not None:
            low[find(i)] = min(low.get(find(i), vec_id), vec_id)
    return [(r[0], links[i], low.get(find(i)) if r[0] is not None else None) for i, r in enumerate(rows)]


def planted(seed=1, hot=60):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist(), 0, 0) for i in range(150)]
    base = rng.standard_normal(16)
    rows += [(1000 + i, (base + rng.standard_normal(16) * 0.12).astype(np.float32).tolist(), 1, 0) for i in range(hot)]
    rows += [(2000 + i, rows[3][1], 1, 0) for i in range(5)] + [(2010, [2 * x for x in rows[3][1]], 1, 0)]
    rows += [(3000, None, 0, 0), (3001, [0.0] * 16, 0, 0), (3002, [float("nan")] + [1.0] * 15, 0, 0), (3003, [None] + [1.0] * 15, 0, 0)]
    rows += [(3004, [float("inf")] * 16, 0, 0), (3005, [], 0, 0), (3006, [1.0, 2.0], 0, 0), (3007, [1.0, 2.01], 0, 0)]
    rows += [(None, rows[3][1], 0, 0), (7, rows[7][1], 0, 0)]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nv, "TILE", 16)
    rows = planted()
    got = nv.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert sum(r.n_links for r in got) >= 0.97 * sum(w[1] for w in want)
    most = {}
    for vec_id, links, _ in want:
        most[vec_id] = max(most.get(vec_id, 0), links)
    assert all(r.n_links <= most[r.vec_id] for r in got)
    assert sorted(map(str, ((r.vec_id, r.component_id) for r in got))) == sorted(map(str, ((w[0], w[2]) for w in want)))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_recall_of_pairs_near_the_threshold(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((700, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.standard_normal((700, 64))
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.93, 0.97, (700, 1))
    matrix = np.vstack([base, cosine * base + np.sqrt(1 - cosine**2) * away]).astype(np.float32)
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(matrix)]
    exact = matrix.astype(np.float64)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    want = int((exact @ exact.T >= 0.95).sum()) - len(rows)
    found = sum(r.n_links for r in nv.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert 0.95 * want <= found <= want and want > 500


def test_empty(spark):
    assert nv.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("edges", [1 << 20, 20, 3])
def test_components(spark, monkeypatch, edges):
    monkeypatch.setattr(components, "TASK_EDGES", edges)
    rng = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 5), (9, 8), (8, 9)]
    pairs = [pairs[i] for i in rng.permutation(len(pairs))]
    got = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    want = {i: 100 for i in range(101, 141)} | {i: 7 for i in range(200, 260)} | {9: 8}
    assert got == want
