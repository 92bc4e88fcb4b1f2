"""Near copies among vectors: random-hyperplane hashing, exact cosines, connected components.

Equal vectors are collapsed first. A table of the index cuts space by ``bits`` random hyperplanes
and names a vector's bucket by the sides it lies on. Two vectors at the angle of the threshold fall
on one side of a plane with probability p = 1 - angle / pi, so they share a bucket in one of
``tables`` tables with probability 1 - (1 - p**bits)**tables. ``bits`` follows the logarithm of the
number of vectors, which keeps chance company in a bucket rare at any size; ``tables`` is what the
wanted recall then takes. Only vectors that have company are sent to their buckets. A bucket is cut
into tiles of bounded size, in which all cosines are computed in double precision; a pair that
shared a bucket of an earlier table is left to that one, so each is counted once. Pairs never become
rows: a tile returns per vector the number of its links and one edge to the smallest vector that it
is connected with in the tile.

A vector that is null, zero, or holds a null or a component that is not finite links with nothing;
so does a row without id. Vectors of different lengths never link. Rows that repeat an id are
vectors of their own with equal results. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.llm.common import join_counted, sorted_runs, star
from brambling.llm.components import connected
from brambling.session import store

COSINE = 0.95
RECALL = 0.99
SPARE_BITS = 3
TILE = 1024
SEED = 20


def table_plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """``(bits, tables)`` for ``n`` vectors."""
    side = 1 - math.acos(cosine) / math.pi
    bits = min(62, max(8, math.ceil(math.log2(max(n, 2))) + SPARE_BITS))
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - side**bits))


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1)


def _signer(bits: int, tables: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            column = batch.column(1)
            lengths = np.asarray(column.value_lengths())
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), bits * tables))
                sides = (_matrix(part.column(1)) @ planes[d] > 0).reshape(part.num_rows, tables, bits)
                names = sides @ weights
                lists = pa.ListArray.from_arrays(np.arange(0, part.num_rows * tables + 1, tables, dtype=np.int32), pa.array(names.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(part.num_rows, d, np.int32)), lists], names=["rep", "d", "names"])

    return sign


def _tile_links(cosine: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[dict[str, np.ndarray]]:
            for batch in batches:
                lengths = np.asarray(batch.column("d"))
                ends = [*(np.flatnonzero(np.diff(lengths)) + 1), len(lengths)]
                for first, last in zip([0, *ends[:-1]], ends):
                    part = batch.slice(first, last - first)
                    chunk = {name: np.asarray(part.column(name)) for name in ("d", "t", "b", "i", "j", "block", "rep", "n")}
                    names = np.asarray(part.column("names").flatten()).reshape(part.num_rows, -1)
                    yield chunk | {"vector": _matrix(part.column("vector")), "names": names}

        for _, stream in itertools.groupby(chunks(), lambda chunk: chunk["d"][0]):
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for run in sorted_runs(stream, ["t", "b", "i", "j"]):
                if len(run["rep"]) < 2:
                    continue
                vectors, names, block, t = run["vector"], run["names"], run["block"], int(run["t"][0])
                norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                near = (vectors @ vectors.T) / norm[:, None] / norm[None, :] >= cosine
                near = np.triu(near, 1)
                if run["i"][0] != run["j"][0]:
                    near &= block[:, None] != block[None, :]
                left, right = np.nonzero(near)
                if t and len(left):
                    new = ~(names[left, :t] == names[right, :t]).any(axis=1)
                    left, right = left[new], right[new]
                if len(left):
                    size = run["n"].astype(np.float64)
                    count = np.bincount(left, size[right], len(size)) + np.bincount(right, size[left], len(size))
                    order = np.argsort(run["rep"], kind="stable")
                    place = np.empty_like(order)
                    place[order] = np.arange(len(order))
                    root = order[star(place[left], place[right], len(order))][place]
                    hit = count > 0
                    out.append((run["rep"][hit], count[hit].astype(np.int64), run["rep"][root][hit]))
                if sum(len(x[0]) for x in out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rep", "links", "root"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rep", "links", "root"])

    return links


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row."""
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(value, lambda x: x != 0)
    good = F.col(vec_id).isNotNull() & F.coalesce(finite & nonzero, F.lit(False))
    # Two hashes name a class of equal vectors.
    key = [F.xxhash64(value).alias("h"), F.xxhash64(F.lit(SEED), value).alias("g")]
    rows = vectors.select(F.col(vec_id).alias("vec_id"), value.alias("vector"), F.coalesce(good, F.lit(False)).alias("good"), *key)
    valid = rows.where("good")
    classes = store(valid.groupBy("h", "g").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")))
    total, n = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bits, tables = table_plan(n, cosine, recall)

    signed = store(classes.select("rep", "vector").mapInArrow(_signer(bits, tables, SEED), "rep long, d int, names array<long>"))
    # Buckets hold vectors of one length; the planes depend on it.
    entries = signed.select("rep", "d", F.posexplode("names").alias("t", "b"))
    company = entries.groupBy("d", "t", "b").agg(F.count("*").alias("size")).where("size > 1")
    company = company.withColumn("blocks", F.ceil(F.col("size") / TILE).cast("int"))
    members = join_counted(entries, company, ["d", "t", "b"], "size", max(1, n * tables))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("rep", "d", "t", "b", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    loaded = members.join(signed.drop("d"), "rep").join(classes.select("rep", "n", "vector"), "rep")
    tiles = loaded.repartition("d", "t", "b", "i", "j").sortWithinPartitions("d", "t", "b", "i", "j")
    links = store(tiles.mapInArrow(_tile_links(cosine), "rep long, links long, root long"))

    component = connected(links, "rep", "root").withColumnRenamed("node", "rep")
    found = links.groupBy("rep").agg(F.sum("links").alias("links"))
    merged = classes.select("h", "g", "rep", "n").join(found, "rep", "left").join(component, "rep", "left")
    merged = store(
        merged.select("h", "g", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    joined = join_counted(valid.select("vec_id", "h", "g"), merged, ["h", "g"], "n", max(1, total))
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = joined.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


# All pairs; the index finds those at the threshold with probability RECALL, closer ones with more.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= {COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
components AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""
