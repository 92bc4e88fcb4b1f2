"""Exact k nearest neighbours (L2) of a table of query vectors, and the vote on their labels.

Vectors come as rows ``(doc_id, entries)``. Pairs never become rows: a task compares its documents
with a block of queries and keeps the k best per query, so what leaves it is at most k rows per query.
Few queries go to every task as they are, after a check of their size, and the documents are not
shuffled. More queries are cut into blocks by their length and a hash, documents too. A block is stored
once, as one row; every pair of blocks that can hold a near pair is a row of a Cartesian product, which
reads the blocks again and shuffles nothing.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brambling.functions.text import label_from_path
from brambling.operators.text_features import TextModel, fit_transform
from brambling.session import bounded_batches, cut, store

# Limits for the rows and the vector entries of one block; blocks are hashed, so these are means.
QUERY_BLOCK, QUERY_ENTRIES = 512, 1 << 21
DOC_BLOCK, DOC_ENTRIES = 4096, 1 << 19
# Squared distances are compared at this many digits, so that the order in which a sum was
# taken cannot decide between equally near documents; the smaller id does.
DIGITS = 10
# Distances that a task holds at a time, and documents of a chunk of the index.
CELLS, CHUNK = 1 << 21, 1024
# Ranks that a query in so many has are multiplied as a matrix.
COMMON = 8
# Into how many rings vectors are cut by their length, at most.
RINGS = 256
# Vectors of up to so many ranks that have most of them are multiplied as matrices, as are many queries:
# in blocks of so many, so many cells at a time, of others the ranks that a query in ``FREQUENT`` has,
# up to so many cells of a block.
DENSE_WIDTH, MANY_CELLS, MANY_BLOCK = 1024, 1 << 20, 4096
FREQUENT, MATRIX_CELLS = 16, 1 << 22
# Products of the other ranks that are summed at a time; their places stay in a processor's cache.
PRODUCTS = 1 << 16


def dense_rows(df: DataFrame, doc_id: Column, vector: str) -> DataFrame:
    """``(doc_id, entries)`` from an array column."""
    entries = F.transform(vector, lambda v, i: F.struct(i.alias("rank"), v.cast("double").alias("value")))
    return df.select(doc_id.alias("doc_id"), entries.alias("entries"))


def _as_arrays(rows: DataFrame) -> DataFrame:
    """``(id, ranks, values)``, the form in which Arrow hands vectors to NumPy without copying.

    Vectors that are null or hold a null or a number that is not finite are left out.
    """
    finite = F.forall("entries", lambda e: e["value"].isNotNull() & ~F.isnan(e["value"]) & (F.abs(e["value"]) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False))).select(
        F.col("doc_id").alias("id"),
        F.transform("entries", lambda e: e["rank"]).alias("ranks"),
        F.transform("entries", lambda e: e["value"]).alias("values"),
    )


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


class _Vectors:
    """A block of sparse vectors: ids, and entry arrays with the row each entry belongs to."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        if isinstance(table, pa.Table):
            table = table.combine_chunks()
        self.ids = np.array(table.column("id").to_pylist(), dtype=object)
        lists = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table.column("ranks"), table.column("values"))]
        lengths = np.asarray(lists[0].value_lengths(), dtype=np.int64)
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.rank, self.value = (np.asarray(column.flatten()) for column in lists)
        self.norm = np.bincount(self.row, weights=self.value**2, minlength=len(lengths))
        # Squared distances that each vector's k nearest are known not to exceed.
        self.bound = np.asarray(table.column("bound")) if "bound" in table.column_names else np.full(len(lengths), np.inf)


def _expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places ``start[i], start[i] + 1, ...``, ``count[i]`` of them, for each i in turn."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + count, count)


def _runs(count: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of ``count`` that sum to about ``most`` each."""
    ends = np.cumsum(count)
    first = 0
    while first < len(count):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, side="right")))
        yield slice(first, last)
        first = last


def _distances(queries: _Vectors, docs: _Vectors, bound: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of ``(ids, squared)``, one row per document and one column per query, not yet rounded.

    Ranks that many of the queries have are multiplied as matrices. All others are looked up in an
    inverted index: per chunk of documents, the postings of each rank and their largest weight.

    With ``bound``, which the caller may lower between chunks, distances above a query's bound may be
    infinite. Documents then come by length, so that those of a chunk need about the same product to be
    near. A query's entries whose largest weights together stay below it are not multiplied; what they
    add is taken for the pairs only that can still be near with all of it.
    """
    asked = len(queries.ids)
    known, column = np.unique(queries.rank, return_inverse=True)
    common = np.bincount(column, minlength=len(known)) * COMMON >= max(1, asked)
    place = np.where(common, np.cumsum(common) - 1, -1)
    frequent, width = common[column], int(common.sum())
    matrix = np.zeros((width, asked))
    matrix[place[column[frequent]], queries.row[frequent]] = queries.value[frequent]
    rank, query, weight = column[~frequent], queries.row[~frequent], queries.value[~frequent]

    order = np.arange(len(docs.ids)) if bound is None else np.argsort(docs.norm, kind="stable")
    turn = np.empty_like(order)
    turn[order] = np.arange(len(order))
    # By rank, the place in ``known``; -1 for the others, and behind the last.
    places = np.full(int(known[-1]) + 2 if len(known) else 1, -1, np.int32)
    places[known] = np.arange(len(known))
    at = places[np.minimum(docs.rank, len(places) - 1)]
    shared = np.flatnonzero(at >= 0)
    shared = shared[np.argsort(turn[docs.row[shared]], kind="stable")]
    row, at, value = turn[docs.row[shared]], at[shared], docs.value[shared]

    step = max(1, min(CHUNK, CELLS // max(1, asked, width)))
    for first in range(0, len(order), step):
        own = order[first : first + step]
        span = slice(*np.searchsorted(row, [first, first + len(own)]))
        doc, term, part = row[span] - first, at[span], value[span]
        often = common[term]
        left = np.bincount(doc[often] * width + place[term[often]], part[often], len(own) * width)
        dots = left.reshape(len(own), width) @ matrix
        doc, term, part = doc[~often], term[~often], part[~often]
        norm, total = docs.norm[own], docs.norm[own][:, None] + queries.norm[None, :]

        kept, spare = np.ones(len(rank), bool), np.zeros(asked)
        if bound is not None:
            # Rounding of the distances, and of the sums here.
            slack = 2 * 10.0**-DIGITS + 1e-9 * (norm.max() + queries.norm)
            peak = np.zeros(len(known))
            np.maximum.at(peak, term, np.abs(part))
            most = np.abs(weight) * peak[rank]
            # The least that the entries below must add to the matrix product for a document to be near.
            need = ((total - bound - slack) / 2 - dots).min(axis=0)
            by = np.lexsort((most, query))
            sums = np.cumsum(most[by])
            start = np.searchsorted(query[by], np.arange(asked))
            sums -= np.concatenate([[0.0], sums])[start][query[by]]
            kept[by[sums < need[query[by]]]] = False
            spare = np.bincount(query[~kept], most[~kept], asked)

        by = np.argsort(term, kind="stable")
        posted, amount = doc[by], part[by]
        starts = np.searchsorted(term[by], np.arange(len(known) + 1))
        entry = np.flatnonzero(kept)
        count = starts[rank[entry] + 1] - starts[rank[entry]]
        entry, count = entry[count > 0], count[count > 0]
        for run in _runs(count, CELLS):
            some, n = entry[run], count[run]
            where = _expand(starts[rank[some]], n)
            cell = posted[where] * asked + np.repeat(query[some], n)
            dots += np.bincount(cell, amount[where] * np.repeat(weight[some], n), dots.size).reshape(dots.shape)

        squared = total - 2.0 * dots
        if not kept.all():
            pair_doc, pair_query = np.nonzero((squared - 2.0 * spare <= bound + slack) & (spare > 0))
            name = rank[~kept] * asked + query[~kept]
            sort = np.argsort(name)
            name, missing = name[sort], weight[~kept][sort]
            lengths = np.bincount(doc, minlength=len(own))
            begin = np.cumsum(lengths) - lengths
            squared[squared - 2.0 * spare > bound + slack] = np.inf
            count = lengths[pair_doc]
            for run in _runs(count, CELLS):
                n = count[run]
                where = _expand(begin[pair_doc[run]], n)
                wanted = term[where] * asked + np.repeat(pair_query[run], n)
                found = np.minimum(np.searchsorted(name, wanted), len(name) - 1)
                product = np.where(name[found] == wanted, part[where] * missing[found], 0.0)
                squared[pair_doc[run], pair_query[run]] -= 2.0 * np.bincount(np.repeat(np.arange(len(n)), n), product, len(n))
        yield docs.ids[own], squared


def _rounded(squared: np.ndarray) -> np.ndarray:
    return np.round(np.maximum(squared, 0.0), DIGITS)


# Documents of a chunk (their ids, and which of them and which query are near, with the squared distance).
_Near = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _near(queries: _Vectors, docs: _Vectors, bound: np.ndarray, k: int) -> Iterator[_Near]:
    """The pairs of each chunk that can be among a query's k nearest; lowers ``bound``."""
    for ids, squared in _distances(queries, docs, bound):
        near = squared <= bound + 10.0**-DIGITS
        many = np.flatnonzero(near.sum(axis=0) > k)
        if len(many):
            kth = _rounded(np.partition(squared[:, many], k - 1, axis=0)[k - 1])
            bound[many] = np.minimum(bound[many], kth)
            near[:, many] &= squared[:, many] <= bound[many] + 10.0**-DIGITS
        doc, query = np.nonzero(near)
        yield ids, doc, query, squared[doc, query]


def _width(vectors: _Vectors) -> int:
    """The number of ranks of vectors that have at least half of them; 0 for others and for very long ones."""
    width = int(vectors.rank.max()) + 1 if len(vectors.rank) else 0
    return width if width <= DENSE_WIDTH and len(vectors.rank) * 2 >= len(vectors.ids) * width else 0


class _Asked:
    """A block of queries, laid out once for all documents that it meets.

    Ranks that many queries have are the columns of a matrix: all ranks of dense vectors, of others the
    most frequent ones. Every other rank has a list of the queries that have it.
    """

    def __init__(self, queries: _Vectors):
        self.queries, n = queries, len(queries.ids)
        known, times = np.unique(queries.rank, return_counts=True)
        often = int((times * FREQUENT >= n).sum())
        self.width = len(known) if _width(queries) else min(often, MATRIX_CELLS // max(1, n))
        # By rank, its column and behind them the number of its list; -1 for ranks that no query has.
        self.place = np.full(int(known[-1]) + 2 if len(known) else 1, -1, np.int32)
        self.place[known[np.argsort(-times, kind="stable")]] = np.arange(len(known))
        place = self.place[queries.rank]
        own = place < self.width
        self.matrix = np.bincount(queries.row[own] * self.width + place[own], queries.value[own], n * self.width).reshape(n, self.width)
        by = np.argsort(place[~own], kind="stable")
        self.query, self.weight = queries.row[~own][by], -2.0 * queries.value[~own][by]
        self.starts = np.searchsorted(place[~own][by], np.arange(self.width, len(known) + 1))

    def __len__(self) -> int:
        return len(self.queries.ids)


def _near_many(asked: _Asked, docs: _Vectors, bound: np.ndarray, k: int) -> Iterator[_Near]:
    """``_near`` for many queries.

    A product in single precision gives the squared distances less what a query allows, but for the
    ranks outside the matrix, and one more number for each row its own length. The other ranks are
    looked up document by document and added in double precision. What rounding can do to the product
    is allowed for, so that no near pair is lost; it is taken in double precision for the pairs found.
    """
    queries, width = asked.queries, asked.width
    longest = docs.norm.max(initial=0.0)
    rounding = (width + 8) * 2.0**-23
    reach = (np.sqrt(queries.norm) + np.sqrt(longest)) ** 2
    kind = np.float32 if reach.max(initial=0.0) < 1e30 else np.float64
    columns = np.concatenate([-2.0 * asked.matrix.T, np.ones((1, len(asked))), queries.norm[None, :]]).astype(kind)
    place = asked.place[np.minimum(docs.rank, len(asked.place) - 1)]
    shared = np.flatnonzero(place >= width)
    row, at, value = docs.row[shared], place[shared] - width, docs.value[shared]
    times = asked.starts[at + 1] - asked.starts[at]
    shared = np.flatnonzero((place >= 0) & (place < width))
    frequent = docs.row[shared], place[shared], docs.value[shared]
    step = max(1, min(CHUNK, MANY_CELLS // max(1, len(asked), width)))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, len(docs.ids), step):
        n = min(step, len(docs.ids) - first)
        norm = docs.norm[first : first + n]
        span = slice(*np.searchsorted(frequent[0], [first, first + n]))
        held = np.bincount((frequent[0][span] - first) * width + frequent[1][span], frequent[2][span], n * width).reshape(n, width)
        rows = np.concatenate([held, norm[:, None] * (1 - rounding), np.ones((n, 1))], axis=1, dtype=kind)
        limit = np.minimum(bound, reach)
        error = rounding * (queries.norm + limit) + 4 * 10.0**-DIGITS
        columns[-1] = queries.norm - limit - error
        product = rows @ columns
        over = product
        span = slice(*np.searchsorted(row, [first, first + n]))
        if span.start < span.stop:
            over = np.zeros((n, len(asked)))
            ends = np.searchsorted(row[span], np.arange(first, first + n + 1)) + span.start
            total = np.concatenate([[0], np.cumsum(times[span])])
            for some in _runs(np.diff(total[ends - span.start]), PRODUCTS):
                own = slice(ends[some.start], ends[some.stop])
                where = _expand(asked.starts[at[own]], times[own])
                cell = asked.query[where] + np.repeat((row[own] - first - some.start) * len(asked), times[own])
                amount = asked.weight[where] * np.repeat(value[own], times[own])
                over[some] = np.bincount(cell, amount, (some.stop - some.start) * len(asked)).reshape(-1, len(asked))
            over += product
        pair = np.flatnonzero(over <= 0)
        query = pair % len(asked)
        many = np.flatnonzero(np.bincount(query, minlength=len(asked)) > k)
        if len(many):
            kth = np.full(len(asked), np.inf)
            kth[many] = np.partition(over[:, many], k - 1, axis=0)[k - 1]
            kth += 2 * (error + rounding * longest)
            bound[:] = np.minimum(bound, limit + kth)
            near = over.ravel()[pair] <= kth[query]
            pair, query = pair[near], query[near]
        doc = pair // len(asked)
        # What the ranks outside the matrix add is the difference.
        squared = norm[doc] + queries.norm[query]
        if over is not product:
            squared += over.ravel()[pair] - product.ravel()[pair]
        for run in range(0, len(pair), max(1, CELLS // max(1, width))):
            some = slice(run, run + max(1, CELLS // max(1, width)))
            squared[some] -= 2.0 * np.einsum("ij,ij->i", held[doc[some]], asked.matrix[query[some]])
        found.append((doc + first, query, squared))
        if first + n == len(docs.ids) or sum(len(part[0]) for part in found) > MANY_CELLS:
            yield docs.ids, *(np.concatenate(parts) for parts in zip(*found))
            found.clear()


def _best(queries: _Vectors, blocks: Iterator[_Vectors], k: int) -> dict[str, list]:
    """The k nearest documents of every query: columns ``query_id, doc_id, squared``."""
    held_query, held_squared = np.zeros(0, np.int64), np.zeros(0)
    held_id = np.zeros(0, object)
    # No document beyond it can be among the k nearest. A bound that another sum gave is rounded up.
    bound = queries.bound + 2 * 10.0**-DIGITS + 1e-9 * (queries.norm + queries.bound)
    asked = _Asked(queries) if len(queries.ids) > QUERY_BLOCK or _width(queries) else None
    for block in blocks:
        pairs = _near(queries, block, bound, k) if asked is None else _near_many(asked, block, bound, k)
        for ids, doc, query, squared in pairs:
            found = _rounded(squared)
            keep = (found <= bound[query]) & np.isfinite(found)
            if not keep.any():
                continue
            doc, query, found = doc[keep], query[keep], found[keep]
            held_query = np.concatenate([held_query, query])
            held_squared = np.concatenate([held_squared, found])
            held_id = np.concatenate([held_id, ids[doc]])
            # Order by query, distance and id, and keep the first k of each query.
            order = _order(held_query, held_squared, held_id)
            held_query, held_squared, held_id = held_query[order], held_squared[order], held_id[order]
            start = np.searchsorted(held_query, held_query)
            place = np.arange(len(held_query)) - start
            last = place == k - 1
            bound[held_query[last]] = np.minimum(bound[held_query[last]], held_squared[last])
            keep = place < k
            held_query, held_squared, held_id = held_query[keep], held_squared[keep], held_id[keep]
    return {"query_id": queries.ids[held_query].tolist(), "doc_id": held_id.tolist(), "squared": held_squared.tolist()}


def _order(query: np.ndarray, squared: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The order by query, distance and id; ids are compared only where the others are equal."""
    order = np.lexsort((squared, query))
    same = (np.diff(query[order]) == 0) & (np.diff(squared[order]) == 0)
    if not same.any():
        return order
    tied = order[np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))]
    name = np.zeros(len(ids), np.int64)
    name[tied] = np.unique(ids[tied], return_inverse=True)[1]
    return np.lexsort((name, squared, query))


def _profile(queries: _Vectors, blocks: Iterator[_Vectors]) -> dict[str, list]:
    """Number, smallest, summed and largest distance of every query to the documents."""
    count, total = 0, np.zeros(len(queries.ids))
    low, high = np.full(len(queries.ids), np.inf), np.zeros(len(queries.ids))
    for block in blocks:
        for ids, squared in _distances(queries, block):
            distance = np.sqrt(_rounded(squared))
            count += len(ids)
            total += distance.sum(axis=0)
            low, high = np.minimum(low, distance.min(axis=0)), np.maximum(high, distance.max(axis=0))
    if not count:
        return {"query_id": [], "n": [], "low": [], "total": [], "high": []}
    return {"query_id": list(queries.ids), "n": [count] * len(total), "low": low, "total": total, "high": high}


@dataclass(frozen=True)
class _Rings:
    """Vectors cut by length into rings of about equal size, and each ring by a hash into blocks.

    What comes to the driver is a row per ring, of which there are at most ``RINGS``. ``packed`` has a
    row per block, with its vectors as bytes.
    """

    placed: DataFrame
    packed: DataFrame
    low: np.ndarray
    high: np.ndarray
    blocks: np.ndarray

    @classmethod
    def of(cls, vectors: DataFrame, rows: int, entries: int) -> _Rings:
        length = F.sqrt(F.aggregate("values", F.lit(0.0), lambda total, v: total + v * v))
        # Stored, so that a length is not summed again for every edge that it is compared with.
        measured = store(vectors.withColumn("_length", length).withColumn("_size", F.size("ranks")))
        size = lambda n, e: max(1, math.ceil(n / rows), math.ceil(e / entries))
        counted = measured.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
        rings = min(RINGS, size(*counted))
        edges = sorted(set(measured.approxQuantile("_length", [i / rings for i in range(1, rings)], 0.001))) if rings > 1 else []
        beyond = F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge <= F.col("_length"))) if edges else F.lit(0)
        ringed = measured.withColumn("_ring", beyond)
        found = {r._ring: r for r in ringed.groupBy("_ring").agg(F.min("_length").alias("low"), F.max("_length").alias("high"), F.count("*").alias("n"), F.sum("_size").alias("e")).collect()}
        every = range(len(edges) + 1)
        low, high = (np.array([found[i][name] if i in found else np.nan for i in every]) for name in ("low", "high"))
        blocks = np.array([size(found[i].n, found[i].e) if i in found else 0 for i in every])
        own = F.get(F.array(*[F.lit(int(x)) for x in blocks]), F.col("_ring"))
        placed = ringed.withColumn("_block", F.pmod(F.xxhash64("id"), own).cast("int")).drop("_length", "_size")
        return cls(placed, cls.pack(placed, int(blocks.sum())), low, high, blocks)

    @staticmethod
    def pack(placed: DataFrame, blocks: int) -> DataFrame:
        """``(_ring, _block, vectors)``, stored: what a pair of blocks needs is read, not computed again.

        A file has few blocks, however many there are: Spark holds thousands of a file's rows at a time.
        """

        def block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            ring, number = ([part.as_py()] for part in key)
            vectors = rows.drop_columns(["_ring", "_block"])
            return pa.table({"_ring": pa.array(ring, pa.int32()), "_block": pa.array(number, pa.int32()), "vectors": pa.array([_pack(vectors)], pa.binary())})

        return store(placed.repartition(max(1, blocks), "_ring", "_block").groupBy("_ring", "_block").applyInArrow(block, "_ring int, _block int, vectors binary"))

    def bounded(self, bound: DataFrame) -> _Rings:
        """The same with ``bound (query_id, bound)`` in each vector."""
        known = self.placed.join(bound, F.col("id") == F.col("query_id"), "left").drop("query_id")
        return replace(self, packed=self.pack(known.withColumn("bound", F.coalesce("bound", F.lit(float("inf")))), int(self.blocks.sum())))

    def gaps(self, others: _Rings) -> np.ndarray:
        """The least distance that vectors of each own ring and each of the others can have."""
        below, above = others.low[None, :] - self.high[:, None], self.low[:, None] - others.high[None, :]
        return np.maximum(0.0, np.maximum(below, above))


def _size(vectors: DataFrame) -> tuple[int, int]:
    """Vectors and their entries."""
    return tuple(vectors.agg(F.count("*"), F.coalesce(F.sum(F.size("ranks")), F.lit(0))).first())


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bytes, bytes]]:
    for batch in batches:
        for row in range(len(batch)):
            ring, number, asked, held = (batch.column(name)[row] for name in ("_q", "_bq", "asked", "held"))
            yield (ring.as_py(), number.as_py()), asked.as_buffer(), held.as_buffer()


def _meeting(queries: _Rings, docs: _Rings, allowed: np.ndarray, meet: Callable[[_Vectors, Iterator[_Vectors]], pa.Table], schema: str) -> DataFrame:
    """``meet`` on each block of queries and the blocks of a task whose rings it is allowed to meet."""
    spark = docs.packed.sparkSession
    # At most RINGS rows of RINGS numbers.
    table = spark.createDataFrame([(q, np.flatnonzero(row).tolist()) for q, row in enumerate(allowed)], "_q int, _with array<int>")
    left = queries.packed.select(F.col("_ring").alias("_q"), F.col("_block").alias("_bq"), F.col("vectors").alias("asked")).join(F.broadcast(table), "_q")
    right = docs.packed.select(F.col("_ring").alias("_d"), F.col("vectors").alias("held"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in itertools.groupby(_pairs(batches), key=lambda pair: pair[0]):
            first = next(own)
            held = (_Vectors(_unpack(pair[2])) for pair in itertools.chain([first], own))
            yield from meet(_Vectors(_unpack(first[1])), held).to_batches()

    met = left.join(right, F.array_contains("_with", F.col("_d"))).select("_q", "_bq", "asked", "held")
    return met.mapInArrow(scan, schema)


def _compare(
    queries: DataFrame,
    docs: DataFrame,
    reduce: Callable[[_Vectors, Iterator[_Vectors]], dict[str, list]],
    columns: str,
    query_block: int | None,
    doc_block: int,
    k: int | None = None,
) -> DataFrame:
    """Apply ``reduce`` to pairs of query and document blocks that together cover all pairs once.

    With ``k``, only pairs that can hold one of the k nearest: by the triangle inequality two vectors
    are no nearer than their lengths differ. A first pass compares each ring of queries with one block
    of the documents next to it in length; its k-th distances bound those of the whole search, and go
    with the queries.
    """
    ids = queries.schema["doc_id"].dataType, docs.schema["doc_id"].dataType
    schema = columns.format(query=ids[0].simpleString(), doc=ids[1].simpleString())
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    left, right = _as_arrays(queries), _as_arrays(docs)
    bounded_batches(docs.sparkSession)

    def batch(result: dict[str, list]) -> pa.Table:
        return pa.Table.from_pydict(result, schema=arrow)

    n, entries = _size(left)
    if n <= (query_block or QUERY_BLOCK) and entries <= QUERY_ENTRIES:
        small = left.toArrow()

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from batch(reduce(_Vectors(small), map(_Vectors, batches))).to_batches()

        return right.mapInArrow(scan, schema)

    def meet(query_block: _Vectors, doc_blocks: Iterator[_Vectors]) -> pa.Table:
        return batch(reduce(query_block, doc_blocks))

    query_block = query_block or (QUERY_BLOCK if k is None else MANY_BLOCK)
    asked, held = _Rings.of(left, query_block, QUERY_ENTRIES), _Rings.of(right, doc_block, DOC_ENTRIES)
    allowed = (asked.blocks[:, None] > 0) & (held.blocks[None, :] > 0)
    gaps = np.where(allowed, asked.gaps(held), np.inf)
    if k is not None and len(held.blocks) > 1:
        middle = np.abs((asked.low + asked.high)[:, None] - (held.low + held.high)[None, :])
        next_to = np.zeros_like(allowed)
        next_to[np.arange(len(gaps)), np.argmin(np.where(allowed, middle, np.inf), axis=1)] = True
        one = replace(held, packed=held.packed.where("_block = 0"))
        tried = _meeting(asked, one, next_to & allowed, meet, schema).groupBy("query_id").agg(F.count("*").alias("n"), F.max("squared").alias("kth"))
        kth = store(tried.where(F.col("n") >= k).select("query_id", F.col("kth").alias("bound")))
        known = asked.placed.join(kth, F.col("id") == F.col("query_id"), "left")
        bound = np.zeros(len(gaps))
        for ring, value in known.groupBy("_ring").agg(F.max(F.coalesce("bound", F.lit(float("inf"))))).collect():
            bound[ring] = value
        # The distances were rounded.
        allowed &= gaps**2 <= bound[:, None] + 2 * 10.0**-DIGITS
        asked = asked.bounded(kth)
    return _meeting(asked, held, allowed, meet, schema)


def nearest(
    queries: DataFrame, docs: DataFrame, k: int = 10, query_block: int | None = None, doc_block: int = DOC_BLOCK
) -> DataFrame:
    """``(query_id, doc_id, position, distance)``: the ``k`` nearest of ``docs`` per query.

    Equal distances are ordered by ``doc_id``. Without ``query_block``, blocks hold as many queries as
    suits their kind. Both inputs are ``(doc_id, entries)`` and should be
    materialised, since the queries are counted first. Null vectors and those with a null or a
    number that is not finite are neither neighbours nor have any.
    """
    found = _compare(
        queries,
        docs,
        lambda block, blocks: _best(block, blocks, k),
        "query_id {query}, doc_id {doc}, squared double",
        query_block,
        doc_block,
        k,
    )
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("squared", "doc_id"))
    return (
        found.withColumn("position", order)
        .where(F.col("position") <= k)
        .select("query_id", "doc_id", "position", F.sqrt("squared").alias("distance"))
    )


def distance_profile(
    queries: DataFrame, docs: DataFrame, query_block: int | None = None, doc_block: int = DOC_BLOCK
) -> DataFrame:
    """Per query: number of documents compared, smallest, mean and largest distance to them."""
    parts = _compare(
        queries,
        docs,
        _profile,
        "query_id {query}, n bigint, low double, total double, high double",
        query_block,
        doc_block,
    )
    return parts.groupBy("query_id").agg(
        F.sum("n").alias("n_docs"),
        F.min("low").alias("min_distance"),
        (F.sum("total") / F.sum("n")).alias("mean_distance"),
        F.max("high").alias("max_distance"),
    )


def vote(neighbours: DataFrame, label: Column) -> DataFrame:
    """``(query_id, label, votes)``: the most frequent label; a tie goes to the nearest neighbour's."""
    counted = neighbours.groupBy("query_id", label.alias("label")).agg(
        F.count("*").alias("votes"), F.min("position").alias("best")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("votes"), "best")
    return counted.withColumn("place", F.row_number().over(order)).where("place = 1").select("query_id", "label", "votes")


def classify(query_ids: DataFrame, neighbours: DataFrame, label: Column) -> DataFrame:
    """A label for every ``query_id``; null for queries without a vector, hence without neighbours."""
    return query_ids.select("query_id").join(vote(neighbours, label), "query_id", "left")


@dataclass(frozen=True)
class TextClassifier:
    """Labels texts by their nearest documents in a corpus whose ids carry the labels."""

    model: TextModel
    vectors: DataFrame

    @classmethod
    def fit(cls, docs: DataFrame, size: int) -> TextClassifier:
        """Fit on ``(doc_id, text)`` with ids such as ``corpus/category/number``."""
        model, vectors = fit_transform(docs, size)
        return cls(model, store(vectors))

    def query_vectors(self, queries: DataFrame, tokenizer: str = "whitespace") -> DataFrame:
        """Vectors of ``(doc_id, text)``; a text without a dictionary word has none."""
        return cut(self.model.transform(queries, tokenizer))

    def neighbours(self, queries: DataFrame, k: int = 10, tokenizer: str = "whitespace") -> DataFrame:
        return nearest(self.query_vectors(queries, tokenizer), self.vectors, k)

    def predict(self, queries: DataFrame, k: int = 10, tokenizer: str = "whitespace") -> DataFrame:
        """``(query_id, label, votes)`` for every query."""
        ids = queries.select(F.col("doc_id").alias("query_id"))
        return classify(ids, self.neighbours(queries, k, tokenizer), label_from_path("doc_id"))
