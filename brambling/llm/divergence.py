"""Source divergence audit: how far the words of the sources of a language are from each other.

1. Terms are runs of letters and characters beyond ASCII, A-Z lowered. A task counts the terms of a
   run of documents in numpy, in buckets by length: up to 8 bytes as one 64-bit number, up to 16 as
   two, both sorted by radix; longer terms are byte strings, one bucket per length, sorted as bytes.
   Equal neighbours are then counted, and the counts of runs merged in the same way, so a task sends
   one row per (language, source, term) it saw, or a few where these are more than it holds.
2. Terms in at least ``LEAST`` documents of a language are kept. With ``count`` occurrences in a group,
   N occurrences of all V kept terms there, a term has p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)).
   A group is the documents of a source in a language, or all of a language.
3. ``pair``: the sum of abs(p - q) over the kept terms, of each two sources of a language. Sources and
   terms are dealt into tiles of bounded size; a tile holds one matrix of p in numpy. A term without
   occurrence in the tile adds the same to every tile, so it is added once as a product.
   ``term``: the terms of a source with the largest p - q, q being the language's.

All numbers are exact integers. Null text, language and source are the empty text. A group without
kept terms, or without terms, is compared like others; with V = 0 all its values are 0. Equal values
rank by their item's UTF-8 bytes. Repeated rows are documents of their own. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brambling.llm.common import slices, sorted_runs
from brambling.llm.packed_words import LETTERS, ONE, TWO, bytes_at, pack_one, pack_two, radix_order, words_in
from brambling.operators.joins import join_small, measure
from brambling.session import store

LEAST = 30
TOP = 50
ADDED, SCALE = 5, 1_000_000_000
RUN_BYTES = 2 << 20
#: A task merges what it counted when it holds so many entries, and sends all when half are left.
HELD = 1 << 20
TILE_SOURCES, TILE_TERMS = 256, 1024
_COUNTS = "lang string, source string, term string, count long, docs long"


class Tally:
    """Occurrences and documents of (term, group), the terms in buckets by their length."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        # By bucket (8, 16, or the length of longer terms): lists of (keys, group, count, docs).
        self.held: dict[int, list[tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, texts: list[bytes], langs: list[str], sources: list[str]) -> None:
        codes = np.array([self.groups.setdefault(key, len(self.groups)) for key in zip(langs, sources)], np.uint64)
        # With documents in order of their group, a stable sort by term leaves groups together.
        dealt = np.argsort(codes, kind="stable")
        codes = codes[dealt]
        buffer, start, length, text = words_in([texts[i] for i in dealt], LETTERS)
        for bucket, chosen in _buckets(length):
            at, size, doc = start[chosen], length[chosen], text[chosen]
            keys = _keys(bucket, buffer, at, size)
            order = _order(keys)
            keys, doc = tuple(k[order] for k in keys), doc[order]
            changes = _changes(*keys)
            first = changes | _changes(codes[doc])
            places = np.flatnonzero(first)
            docs = np.add.reduceat((changes | _changes(doc)).astype(np.int64), places)
            self._hold(bucket, tuple(k[places] for k in keys), codes[doc[places]], np.diff(places, append=len(doc)), docs)

    def _hold(self, bucket: int, keys: tuple[np.ndarray, ...], group: np.ndarray, count: np.ndarray, docs: np.ndarray) -> None:
        self.held.setdefault(bucket, []).append((keys, group, count, docs))
        self.size += len(group)

    def merge(self) -> None:
        parts, self.held, self.size = self.held, {}, 0
        for bucket, own in parts.items():
            keys = tuple(np.concatenate(k) for k in zip(*(p[0] for p in own)))
            group, count, docs = (np.concatenate([p[i] for p in own]) for i in (1, 2, 3))
            order = _order(keys, group)
            keys, group = tuple(k[order] for k in keys), group[order]
            places = np.flatnonzero(_changes(*keys, group))
            self._hold(bucket, tuple(k[places] for k in keys), group[places], np.add.reduceat(count[order], places), np.add.reduceat(docs[order], places))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All that is held; the tally is empty then."""
        self.merge()
        names = list(self.groups)
        langs, sources = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
        for keys, group, count, docs in (own for held in self.held.values() for own in held):
            for a in range(0, len(group), 1 << 16):
                part = slice(a, a + (1 << 16))
                code = pa.array(group[part].astype(np.int64))
                columns = [langs.take(code), sources.take(code), _terms(tuple(k[part] for k in keys)), pa.array(count[part]), pa.array(docs[part])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])
        self.groups, self.held, self.size = {}, {}, 0


def _buckets(length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(bucket, words in it)``."""
    for bucket, chosen in ((ONE, length <= ONE), (TWO, (length > ONE) & (length <= TWO))):
        if chosen.any():
            yield bucket, np.flatnonzero(chosen)
    long = np.flatnonzero(length > TWO)
    order = long[np.argsort(length[long], kind="stable")]
    if len(order):
        yield from ((int(length[part[0]]), part) for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1))


def _keys(bucket: int, buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    if bucket == ONE:
        return (pack_one(buffer, start, length),)
    return pack_two(buffer, start, length) if bucket == TWO else (bytes_at(buffer, start, bucket),)


def _order(keys: tuple[np.ndarray, ...], then: np.ndarray | None = None) -> np.ndarray:
    """The order of rows by their keys, then by a number."""
    if keys[0].dtype.kind != "S":
        return radix_order(*keys) if then is None else radix_order(*keys, then)
    if then is None:
        return np.argsort(keys[0], kind="stable")
    order = radix_order(then)
    return order[np.argsort(keys[0][order], kind="stable")]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def _terms(keys: tuple[np.ndarray, ...]) -> pa.Array:
    """The terms as Arrow strings."""
    n = len(keys[0])
    if keys[0].dtype.kind == "S":
        raw = keys[0]
        data, size = raw.tobytes(), np.full(n, raw.dtype.itemsize)
    else:
        raw = np.stack(keys, axis=1).astype(">u8").view(np.uint8)
        used = raw != 0
        data, size = raw[used].tobytes(), used.sum(axis=1)
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data)).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally()
    for batch, texts in slices(batches, "text", RUN_BYTES):
        tally.add(texts, batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        if tally.size > HELD:
            tally.merge()
            if tally.size > HELD // 2:
                yield from tally.rows()
    yield from tally.rows()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, count, docs)``: how often a term occurs in a group, and in how many documents."""
    named = {"lang": lang, "source": source, "text": text}
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()))
    return rows.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str | int, total: str) -> Column:
    """p of ``count`` occurrences where the kept terms have ``total``; decimals, so that nothing is rounded. Without kept terms it has no use."""
    return F.expr(f"1 + (cast({SCALE} AS decimal(10,0)) * cast({count} + {ADDED} AS decimal(20,0))) div cast(greatest(1, {total} + {ADDED} * terms) AS decimal(20,0))")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per two sources of a tile's terms. A row without term has its source's p where it has no occurrence."""
    names = ("lang", "i", "j", "bucket", "slot", "t", "p", "terms")

    def chunks() -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            yield {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}

    key, slots, sums = None, None, None

    def flush() -> pa.RecordBatch:
        side = slots // TILE_SOURCES
        a, b = np.triu_indices(len(slots), 1)
        own = side[a] != side[b] if key[1] != key[2] else np.ones(len(a), bool)
        a, b = a[own], b[own]
        columns = [pa.array([key[0]] * len(a), pa.string()), pa.array(slots[a]), pa.array(slots[b]), pa.array(sums[a, b])]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

    for run in sorted_runs(chunks(), ["lang", "i", "j", "bucket"]):
        bare = run["t"] < 0
        order = np.argsort(run["slot"][bare])
        own, plain = run["slot"][bare][order], run["p"][bare][order]
        here = (run["lang"][0], run["i"][0], run["j"][0])
        if here != key:
            if key:
                yield flush()
            key, slots, sums = here, own, np.zeros((len(own), len(own)), np.int64)
        terms, row = np.unique(run["t"][~bare], return_inverse=True)
        p = np.tile(plain, (len(terms), 1))
        p[row, np.searchsorted(own, run["slot"][~bare])] = run["p"][~bare]
        # Terms that no source of the tile has, over all buckets, are counted with the first one.
        rest = (int(run["terms"][0]) if run["bucket"][0] == 0 else 0) - len(terms)
        for k in range(len(own)):
            sums[k] += np.abs(p - p[:, k : k + 1]).sum(axis=0) + rest * np.abs(plain - plain[k])
    if key:
        yield flush()


def _pair_sums(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for each two slots a < b of a language."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("terms") / TILE_TERMS)).cast("int")
    blocks = F.ceil(F.col("sources") / TILE_SOURCES).cast("int")
    facts = ["lang", "slot", "terms", "sources"]
    bare = groups.select(*facts, F.lit(-1).cast("long").alias("t"), share(0, "n").alias("p"), F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"))
    own = entries.select(*facts, "t", "p", F.pmod(F.xxhash64("t"), buckets).cast("int").alias("bucket"))
    mine = F.floor(F.col("slot") / TILE_SOURCES).cast("int")
    # In a tile of two blocks of sources, both of them have all their rows.
    dealt = bare.unionByName(own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("lang", F.least(mine, "other").alias("i"), F.greatest(mine, "other").alias("j"), "bucket", "slot", "t", "p", "terms")
    tiles = dealt.repartition("lang", "i", "j", "bucket").sortWithinPartitions("lang", "i", "j", "bucket")
    return tiles.mapInArrow(_pairs, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of both parts."""
    counts = store(term_counts(docs, text, lang, source))
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("all")).where(F.col("docs") >= least).drop("docs")
    # The numbers hold, as they are those of a written table.
    terms = store(store(terms).withColumn("t", F.monotonically_increasing_id()))
    kept = store(join_small(counts.drop("docs"), terms, ["lang", "term"], measure(terms)[1]))

    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("n_lang"))
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source))))
    groups = named.distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "terms", "n_lang"])
    slot = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = store(groups.withColumns({"slot": slot, "sources": F.count("*").over(Window.partitionBy("lang")).cast("int")}))
    size = measure(groups)[1]

    entries = join_small(kept, groups, ["lang", "source"], size).withColumns({"p": share("count", "n"), "q": share("all", "n_lang")})
    values = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    shape = ["lang", "source", "part", "item", "value", "rank"]
    over = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    top_terms = over.withColumn("rank", values).where(F.col("rank") <= top).select(shape)

    half = store(_pair_sums(entries, groups))
    both = half.unionByName(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda slot, as_: groups.select(F.col("lang"), F.col("slot").alias(slot), F.col("source").alias(as_))
    pairs = join_small(join_small(both, name("a", "source"), ["lang", "a"], size), name("b", "item"), ["lang", "b"], size)
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", values).select(shape)
    return pairs.unionByName(top_terms)


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHARE = f"(1 + ({SCALE}::HUGEINT * ({{count}} + {ADDED})) // ({{n}} + {ADDED} * v))::BIGINT"
ORACLE = f"""
WITH rows AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWERED} AS text FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM rows),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST}),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n_lang FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM rows),
every AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, {_SHARE.format(count="coalesce(c, 0)", n="coalesce(n, 0)")} AS p, {_SHARE.format(count="total", n="n_lang")} AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM every WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
