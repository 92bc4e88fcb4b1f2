from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling import session
from brambling.functions.text import label_from_path
from brambling.operators import neighbours as nn


@pytest.fixture(scope="module")
def vectors():
    random = np.random.RandomState(1)
    table = random.rand(300, 12) * (random.rand(300, 12) < 0.4)
    table[200:] = table[7]  # a third of all rows are copies of one vector
    table[:, 0] += 0.01  # no vector is empty
    return table


def frame(spark, table, prefix):
    rows = [(f"{prefix}/{'xyz'[i % 3]}/{i:03d}", [float(v) for v in row]) for i, row in enumerate(table)]
    dense = spark.createDataFrame(rows, "id string, v array<double>").repartition(4)
    found = nn.dense_rows(dense, F.col("id"), "v")
    return found.withColumn("entries", F.filter("entries", lambda e: e["value"] != 0)).cache()


def brute(queries, docs, k):
    squared = np.round(((queries[:, None, :] - docs[None, :, :]) ** 2).sum(-1), nn.DIGITS)
    ids = np.array([f"d/{'xyz'[i % 3]}/{i:03d}" for i in range(len(docs))])
    out = {}
    for q, row in enumerate(squared):
        best = sorted(zip(row, ids))[:k]
        out[f"q/{'xyz'[q % 3]}/{q:03d}"] = [(str(i), round(float(np.sqrt(d)), 6)) for d, i in best]
    return out


def found(df):
    out: dict = {}
    for row in df.orderBy("query_id", "position").collect():
        out.setdefault(row.query_id, []).append((row.doc_id, round(row.distance, 6)))
    return out


def test_neighbours_equal_brute_force(spark, vectors):
    queries = frame(spark, vectors[:40], "q")
    docs = frame(spark, vectors, "d")
    want = brute(vectors[:40], vectors, 10)
    assert found(nn.nearest(queries, docs, 10)) == want
    # The same through blocks of both sides.
    assert found(nn.nearest(queries, docs, 10, query_block=7, doc_block=60)) == want


def test_blocks_too_far_apart_are_skipped(spark, monkeypatch):
    random = np.random.RandomState(5)
    table = (1 + 0.1 * random.rand(400, 6)) * np.repeat([1.0, 3.0, 9.0, 27.0], 100)[:, None]
    queries, docs = frame(spark, table[::4], "q"), frame(spark, table, "d")
    met = []
    meeting = nn._meeting
    monkeypatch.setattr(nn, "_meeting", lambda q, d, allowed, *rest: met.append(allowed) or meeting(q, d, allowed, *rest))
    assert found(nn.nearest(queries, docs, 5, query_block=20, doc_block=50)) == brute(table[::4], table, 5)
    assert len(met) == 2 and not met[1].all() and met[1].sum() < 0.85 * met[1].size


def test_a_vector_is_stored_once_however_many_blocks_it_meets(spark, vectors, monkeypatch):
    queries, docs = frame(spark, vectors[:40], "q"), frame(spark, vectors, "d")
    met = []
    meeting = nn._meeting
    monkeypatch.setattr(nn, "_meeting", lambda q, d, *rest: met.append((q, d)) or meeting(q, d, *rest))
    for find in (lambda: nn.nearest(queries, docs, 10, query_block=7, doc_block=60), lambda: nn.distance_profile(queries, docs, query_block=7, doc_block=60)):
        met.clear()
        plan = find()._jdf.queryExecution().executedPlan().toString()
        assert "CoGroups" not in plan and "hashpartitioning(_" not in plan
        for side, n in zip(met[-1], (40, 300)):
            assert sum(len(nn._unpack(bytes(row.vectors))) for row in side.packed.collect()) == n


def test_batches_of_documents_end_at_bytes(spark, vectors, monkeypatch):
    queries, docs = frame(spark, vectors[:5], "q"), frame(spark, vectors, "d").coalesce(1)
    spark.conf.unset(session.BATCH_SETTING)
    monkeypatch.setattr(session, "BATCH_BYTES", 1000)
    sizes = spark.sparkContext.accumulator(0)
    plain = nn._best
    monkeypatch.setattr(nn, "_best", lambda q, blocks, k: plain(q, (sizes.add(1) or b for b in blocks), k))
    try:
        assert found(nn.nearest(queries, docs, 10)) == brute(vectors[:5], vectors, 10)
        assert sizes.value > 10
    finally:
        spark.conf.unset(session.BATCH_SETTING)


def test_bounds_of_the_first_pass_lose_no_neighbour(spark, vectors):
    queries, docs = frame(spark, vectors[190:230], "q"), frame(spark, vectors, "d")
    want = brute(vectors[190:230], vectors, 10)
    for blocks in ((5, 12), (40, 30), (9, 400)):
        assert found(nn.nearest(queries, docs, 10, *blocks)) == want


def test_small_chunks_change_nothing(spark, vectors, monkeypatch):
    block = nn._distances
    monkeypatch.setattr(nn, "CELLS", 64)
    ids = {"id": [f"{i}" for i in range(30)]}
    import pyarrow as pa

    def table(rows):
        return pa.table(
            {
                **ids,
                "ranks": [list(np.flatnonzero(r).astype(np.int32)) for r in rows],
                "values": [list(r[np.flatnonzero(r)]) for r in rows],
            }
        )

    left = nn._Vectors(table(vectors[:30]))
    parts = np.concatenate([d for _, d in block(left, nn._Vectors(table(vectors[30:60])))])
    want = ((vectors[30:60, None, :] - vectors[None, :30, :]) ** 2).sum(-1)
    assert np.allclose(parts, want, atol=1e-9)


def sparse_block(random, rows, ranks, prefix):
    """Texts of frequent words with small weights and rare ones with large weights."""
    import pyarrow as pa

    chances = 1 / np.arange(2, ranks + 2)
    entries = [np.unique(random.choice(ranks, 40, p=chances / chances.sum())).astype(np.int32) for _ in range(rows)]
    values = [np.log(2 + r) ** 2 / 40 * (1 + random.rand(len(r))) * random.choice([-1, 1, 1, 1], len(r)) for r in entries]
    dense = np.zeros((rows, ranks))
    for i, (r, v) in enumerate(zip(entries, values)):
        dense[i, r] = v
    return nn._Vectors(pa.table({"id": [f"{prefix}/{i:05d}" for i in range(rows)], "ranks": entries, "values": values})), dense


def test_index_skips_products_and_stays_exact(monkeypatch):
    random = np.random.RandomState(8)
    queries, asked = sparse_block(random, 60, 3000, "q")
    docs, held = sparse_block(random, 4000, 3000, "d")
    squared = np.round(((asked[:, None, :] - held[None]) ** 2).sum(-1), nn.DIGITS)
    order = np.argsort(squared, axis=1, kind="stable")[:, :10]
    products = []
    expand = nn._expand
    monkeypatch.setattr(nn, "_expand", lambda start, count: products.append(int(count.sum())) or expand(start, count))
    monkeypatch.setattr(nn, "CHUNK", 256)
    for common in (8, 0):  # frequent ranks as a matrix, and all ranks by the index
        monkeypatch.setattr(nn, "COMMON", common)
        products.clear()
        best = nn._best(queries, iter([docs]), 10)
        got = {}
        for query, doc, distance in zip(best["query_id"], best["doc_id"], best["squared"]):
            got.setdefault(query, []).append((doc, distance))
        for q, near in enumerate(order):
            assert [doc for doc, _ in got[f"q/{q:05d}"]] == [f"d/{d:05d}" for d in near]
            assert np.allclose([distance for _, distance in got[f"q/{q:05d}"]], squared[q, near], atol=1e-8)
        bounded = sum(products)
        products.clear()
        every = [d for _, d in nn._distances(queries, docs)]
        assert np.allclose(np.concatenate(every), squared.T, atol=1e-8)
        assert bounded < 0.8 * sum(products)


def dense_block(table, prefix):
    import pyarrow as pa

    ranks = [np.arange(table.shape[1], dtype=np.int32)] * len(table)
    return nn._Vectors(pa.table({"id": [f"{prefix}/{i:05d}" for i in range(len(table))], "ranks": ranks, "values": list(table)}))


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e6, 1e18])
def test_dense_search_is_exact_in_single_precision(monkeypatch, scale):
    random = np.random.RandomState(11)
    table = random.randn(900, 16)
    table[300:330] = table[5] + 1e-7 * random.randn(30, 16)  # nearer to each other than single precision can tell
    table[400:440] = table[9]  # and copies, of which the smallest ids count
    table *= scale
    monkeypatch.setattr(nn, "CHUNK", 64)
    monkeypatch.setattr(nn, "_distances", None)
    docs = [dense_block(table[i : i + 200], f"d/{i // 200}") for i in range(0, 900, 200)]
    best = nn._best(dense_block(table[:500], "q"), iter(docs), 10)
    ids = np.concatenate([d.ids for d in docs])
    norm = (table**2).sum(1)
    squared = np.round(np.maximum(norm[:500, None] + norm[None] - 2 * np.einsum("qi,di->qd", table[:500], table), 0), nn.DIGITS)
    got = {}
    for query, doc, distance in zip(best["query_id"], best["doc_id"], best["squared"]):
        got.setdefault(int(query[2:]), []).append((doc, distance))
    for q in range(500):
        assert len(got[q]) == 10
        exact = ((table[q] - table) ** 2).sum(1)
        at = {i: n for n, i in enumerate(ids)}
        assert np.allclose(sorted(exact)[:10], [exact[at[d]] for d, _ in got[q]], atol=1e-8 + 1e-14 * norm.max())
        assert np.allclose([s for _, s in got[q]], np.sort(squared[q])[:10], atol=1e-8 + 1e-14 * norm.max())
    if scale == 1.0:
        copies = [9, *range(400, 440)]
        assert [d for d, _ in got[9]] == list(ids[copies[:10]])


def test_documents_with_ranks_that_dense_queries_lack():
    import pyarrow as pa

    random = np.random.RandomState(12)
    wide = random.randn(80, 9) * (random.rand(80, 9) < 0.6)
    entries = [np.flatnonzero(row).astype(np.int32) for row in wide]
    docs = nn._Vectors(pa.table({"id": [f"d/{i:03d}" for i in range(80)], "ranks": entries, "values": [row[at] for row, at in zip(wide, entries)]}))
    narrow = random.randn(20, 4)
    best = nn._best(dense_block(narrow, "q"), iter([docs]), 3)
    squared = ((np.pad(narrow, ((0, 0), (0, 5)))[:, None] - wide[None]) ** 2).sum(-1)
    want = [f"d/{i:03d}" for row in squared for i in np.argsort(row)[:3]]
    assert best["doc_id"] == want and np.allclose(best["squared"], np.sort(squared, axis=1)[:, :3].ravel(), atol=1e-9)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e18])
@pytest.mark.parametrize("cells", [1 << 22, 700 * 20, 0])  # of the matrix of frequent ranks: all of them, some, none
def test_many_sparse_queries_are_exact_by_products(monkeypatch, cells, scale):
    import pyarrow as pa

    random = np.random.RandomState(21)
    docs, held = sparse_block(random, 1500, 400, "d")
    held[600:640] = held[3]  # copies, of which the smallest ids count
    held[700:720] = held[4] * (1 + 1e-7 * random.randn(20, 1))  # nearer to each other than single precision can tell
    held *= scale

    def block(rows, prefix):
        entries = [np.flatnonzero(row).astype(np.int32) for row in rows]
        values = [row[at] for row, at in zip(rows, entries)]
        return nn._Vectors(pa.table({"id": [f"{prefix}/{i:05d}" for i in range(len(rows))], "ranks": pa.array(entries, pa.list_(pa.int32())), "values": pa.array(values, pa.list_(pa.float64()))}))

    asked = np.concatenate([held[:698], np.zeros((2, 400))])  # vectors of zeros have no entries
    asked[5:400, 390:] = 0
    monkeypatch.setattr(nn, "_distances", None)
    monkeypatch.setattr(nn, "MATRIX_CELLS", cells)
    monkeypatch.setattr(nn, "CHUNK", 64)
    monkeypatch.setattr(nn, "PRODUCTS", 500)
    queries = block(asked, "q")
    assert 0 < len(nn._Asked(queries).query) or cells == 1 << 22
    best = nn._best(queries, iter([block(held[i : i + 300], f"d/{i // 300}") for i in range(0, 1500, 300)]), 10)
    squared = np.array([((held - row) ** 2).sum(1) for row in asked])
    got = {}
    for query, doc, distance in zip(best["query_id"], best["doc_id"], best["squared"]):
        part, row = doc[2:].split("/")
        got.setdefault(int(query[2:]), []).append((int(part) * 300 + int(row), distance))
    norm = (held**2).sum(1).max()
    for q in range(700):
        near, distances = zip(*got[q])
        assert np.allclose(np.sort(squared[q])[:10], squared[q, list(near)], atol=1e-8 + 1e-14 * norm)
        assert np.allclose(distances, np.sort(squared[q])[:10], atol=1e-8 + 1e-14 * norm)
    if scale == 1.0:
        assert [d for d, _ in got[3]] == [3, *range(600, 609)]


def test_a_block_of_documents_meets_many_sparse_queries_at_once(spark, monkeypatch):
    """Blocks of few queries would lay the same documents out again for each of them."""
    random = np.random.RandomState(22)
    table = random.rand(1400, 40) * (random.rand(1400, 40) < 0.2)
    table[:, 0] += 0.01
    queries, docs = frame(spark, table[:700], "q"), frame(spark, table, "d")
    met = []
    meeting = nn._meeting
    monkeypatch.setattr(nn, "_meeting", lambda q, *rest: met.append(q) or meeting(q, *rest))
    assert found(nn.nearest(queries, docs, 3, doc_block=500)) == brute(table[:700], table, 3)
    assert met[-1].packed.count() == 1


def test_a_file_has_few_blocks_however_many_there_are(spark):
    table = np.random.RandomState(23).randn(1200, 4)
    rings = nn._Rings.of(nn._as_arrays(frame(spark, table, "d")), 6, nn.DOC_ENTRIES)
    bounds = spark.createDataFrame([("d/x/000", 1.0)], "query_id string, bound double")
    for packed in (rings.packed, rings.bounded(bounds).packed):
        per_file = [r["count"] for r in packed.groupBy(F.input_file_name()).count().collect()]
        assert sum(per_file) >= 150 and max(per_file) <= 12


def test_ids_decide_between_equal_distances_only():
    random = np.random.RandomState(13)
    query, squared = random.randint(0, 5, 400), random.randint(0, 30, 400) / 4
    ids = np.array([f"{i}" for i in random.permutation(400)], dtype=object)
    assert [tuple(x) for x in zip(query, squared, ids)] != sorted(zip(query, squared, ids))
    order = nn._order(query, squared, ids)
    assert list(zip(query[order], squared[order], ids[order])) == sorted(zip(query, squared, ids))


def test_lengths_are_summed_once_for_all_rings(spark):
    table = np.random.RandomState(14).randn(300, 6)
    placed = nn._Rings.of(nn._as_arrays(frame(spark, table, "d")), 20, nn.DOC_ENTRIES).placed
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "_ring" in plan and "aggregate(" not in plan


def test_a_vector_is_its_own_nearest_neighbour(spark, vectors):
    docs = frame(spark, vectors, "d")
    first = nn.nearest(docs, docs, 1, query_block=100, doc_block=100)
    assert first.count() == 300
    assert first.agg(F.max("distance")).first()[0] == 0


def test_fewer_documents_than_neighbours(spark, vectors):
    docs = frame(spark, vectors[:4], "d")
    assert nn.nearest(docs, docs, 10).count() == 16


def test_bad_vectors_are_left_out(spark):
    random = np.random.RandomState(2)
    good = [(f"d/x/{i}", [float(v) for v in random.rand(4)]) for i in range(4)]
    nan = [(f"d/y/{i}", [float("nan"), 1.0, 1.0, 1.0]) for i in range(20)]
    bad = nan + [("d/y/null", None), ("d/y/hole", [None, 1.0, 1.0, 1.0]), ("d/y/inf", [float("inf"), 1.0, 1.0, 1.0])]
    docs = nn.dense_rows(spark.createDataFrame(good + bad, "id string, v array<double>"), F.col("id"), "v").cache()
    asked = [(i, v) for i, (_, v) in enumerate(good + bad)]
    queries = nn.dense_rows(spark.createDataFrame(asked, "id int, v array<double>"), F.col("id"), "v").cache()
    ids = queries.select(F.col("doc_id").alias("query_id"))
    for sizes in ({}, {"query_block": 2, "doc_block": 3}):
        near = nn.nearest(queries, docs, 10, **sizes)
        assert {(r.query_id, r.doc_id) for r in near.collect()} == {(q, d) for q in range(4) for d, _ in good}
        labels = {r.query_id: r.label for r in nn.classify(ids, near, label_from_path("doc_id")).collect()}
        assert labels == {i: "x" if i < 4 else None for i in range(len(asked))}


def test_profile(spark, vectors):
    queries, docs = frame(spark, vectors[:20], "q"), frame(spark, vectors, "d")
    distance = np.sqrt(((vectors[:20, None, :] - vectors[None, :, :]) ** 2).sum(-1))
    for sizes in ({}, {"query_block": 6, "doc_block": 50}):
        rows = nn.distance_profile(queries, docs, **sizes).orderBy("query_id").collect()
        ids = sorted(range(20), key=lambda q: f"q/{'xyz'[q % 3]}/{q:03d}")
        assert [r.n_docs for r in rows] == [300] * 20
        assert np.allclose([r.mean_distance for r in rows], distance.mean(1)[ids], atol=1e-6)
        assert np.allclose([r.min_distance for r in rows], distance.min(1)[ids], atol=1e-5)
        assert np.allclose([r.max_distance for r in rows], distance.max(1)[ids], atol=1e-6)


def test_vote_tie_goes_to_the_nearest(spark):
    rows = [("q", "d/b/1", 1), ("q", "d/a/2", 2), ("q", "d/a/3", 3), ("q", "d/b/4", 4), ("r", "d/c/1", 1)]
    df = spark.createDataFrame(rows, "query_id string, doc_id string, position int")
    votes = {r.query_id: (r.label, r.votes) for r in nn.vote(df, label_from_path("doc_id")).collect()}
    assert votes == {"q": ("b", 2), "r": ("c", 1)}


def test_text_classifier(spark):
    docs = [
        ("n/pets/1", "the cat sat"),
        ("n/pets/2", "a cat and a dog"),
        ("n/law/3", "the court of law"),
        ("n/law/4", "court and law"),
    ]
    queries = [(1, "the CAT sat"), (2, "law law court"), (3, "court, zebra"), (4, "")]
    classifier = nn.TextClassifier.fit(spark.createDataFrame(docs, "doc_id string, text string"), 20)
    asked = spark.createDataFrame(queries, "doc_id int, text string")
    got = {r.query_id: r.label for r in classifier.predict(asked, 2).collect()}
    # Punctuation stays on query words unless the other tokenizer is asked for.
    assert got == {1: "pets", 2: "law", 3: None, 4: None}
    letters = {r.query_id: r.label for r in classifier.predict(asked, 2, tokenizer="letters").collect()}
    assert letters[3] == "law"
