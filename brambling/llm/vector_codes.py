"""Vector codes by product quantization, with codebooks from Lloyd rounds over resident members.

A vector is cut into parts; each part position has a codebook of its own, and a vector's code is the
index of the nearest entry at each position. Everything is computed on integers.

1. Each part of each vector is a row. It lives with the owner of (position, entry, salt), entry being
   the one it is assigned to; the salt is a hash of the row, so that an entry with many members has
   many owners of bounded size.
2. In a round, owners sum their resident members and an entry becomes the mean of its members. Each
   member is then compared with the new entries where it is. Those that keep their entry stay in the
   files they are in; only those that change it go through a shuffle, to their new owner.
3. What owners send is one sum per (task, position, entry); what the driver holds are codebooks, whose
   size is ``PARTS`` x ``ENTRIES`` x the length of a part, whatever the number of vectors.

Every member state is a written table; a round reads the one before it, so a lost executor costs the
repetition of its tasks.

Vectors that are null, or hold a null or a component that is not finite, are left out. A component x
becomes floor(SCALE * x), held within +-``MOST``. The codebooks start as the parts of the vectors with the
smallest ids; of rows that repeat an id those that are smaller as arrays come first, and a null id
comes last. Fewer vectors than entries make smaller codebooks. If a length is not a multiple of the
number of parts, the first parts are longer by one. Vectors whose length is not that of the first one
cannot be compared with it: their code, error and label error are null. Repeated rows are rows of their
own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.llm.common import join_measured, key_of
from brambling.session import discard, spill, store

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, MOST = 256, 1 << 22
#: Members of a position and salt, on average; an owner holds those of one entry.
RESIDENT = 1 << 12
CHUNK = 1 << 14
#: Below this, products and sums of a part's components are exact as doubles.
_EXACT = 1 << 53

Codebooks = list[np.ndarray]
_MEMBER = "id long, position int, entry int, salt int, part array<int>"


def integers(vector: Column) -> Column:
    """The components as integers, or null where a vector cannot be used."""
    value = vector.cast("array<double>")
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.transform(value, lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x * SCALE))).cast("int"))
    return F.when(F.coalesce(usable, F.lit(False)), held)


def bounds(length: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [k * (length // parts) + min(k, length % parts) for k in range(parts + 1)]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(entry, squared distance)`` of each row of ``parts``; ties go to the lower entry."""
    largest = int(max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)))
    # Doubles for speed where all sums stay exact.
    kind = np.float64 if 4 * largest * largest * max(1, parts.shape[1]) < _EXACT else np.int64
    a, b = parts.astype(kind), book.astype(kind)
    entry, distance = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(0, len(a), CHUNK):
        x = a[k : k + CHUNK]
        every = (x * x).sum(axis=1)[:, None] - 2 * (x @ b.T) + (b * b).sum(axis=1)[None, :]
        best = every.argmin(axis=1)
        entry[k : k + CHUNK], distance[k : k + CHUNK] = best, every[np.arange(len(x)), best]
    return entry, distance


def _members(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(position, rows, parts)`` of a batch of members."""
    position = np.asarray(batch.column("position"))
    for p in np.unique(position):
        rows = np.flatnonzero(position == p)
        own = batch.column("part").take(pa.array(rows))
        yield int(p), rows, np.asarray(own.flatten(), np.int64).reshape(len(rows), -1)


def _assign(books: Codebooks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members with the entry that is nearest now, and their distance."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, error = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for p, rows, parts in _members(batch):
                entry[rows], error[rows] = nearest(parts, books[p])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(entry), pa.array(error)], names=[*batch.schema.names, "nearest", "error"])

    return assign


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per position and entry the number and sum of a task's resident members."""
    sums: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for batch in batches:
        entry = np.asarray(batch.column("entry"))
        for p, rows, parts in _members(batch):
            own = entry[rows]
            order = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.diff(own[order], prepend=-1))
            number = np.diff(first, append=len(order))
            # A part without components has an empty sum.
            total = np.add.reduceat(parts[order], first, axis=0) if parts.shape[1] else parts[: len(first)]
            for e, n, s in zip(own[order][first], number, total):
                before = sums.get((p, int(e)), (0, 0))
                sums[p, int(e)] = before[0] + int(n), before[1] + s
    columns = list(zip(*((p, e, n, s) for (p, e), (n, s) in sums.items()))) or [[], [], [], []]
    kinds = pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["position", "entry", "n", "sum"])


def updated(books: Codebooks, members: DataFrame) -> Codebooks:
    """Each entry as the floor of the mean of its members; entries without members stay."""
    owned = members.select("position", "entry", "part").mapInArrow(_sum, "position int, entry int, n long, sum array<long>")
    slots = owned.select("position", "entry", "n", F.posexplode_outer("sum").alias("slot", "value"))
    sums = slots.groupBy("position", "entry", "slot").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    out = [b.copy() for b in books]
    # At most one number per component of the codebooks.
    for r in sums.where("slot is not null").toLocalIterator():
        out[r.position][r.entry, r.slot] = r.value // r.n
    return out


def first_books(rows: DataFrame, cuts: list[int], entries: int = ENTRIES) -> Codebooks:
    """The parts of the ``entries`` vectors with the smallest ids."""
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "value").limit(entries).select("value").collect()
    matrix = np.array([r.value for r in chosen], np.int64).reshape(len(chosen), cuts[-1])
    return [matrix[:, a:b] for a, b in zip(cuts, cuts[1:])]


def members_of(rows: DataFrame, cuts: list[int], salts: int) -> DataFrame:
    """A row per part of each vector."""
    cut = F.array(*(F.struct(F.lit(k).alias("position"), F.slice("value", a + 1, b - a).alias("part")) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))))
    each = rows.select("id", F.explode(cut).alias("p"))
    return each.select("id", "p.position", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"), "p.part")


def moved(assigned: DataFrame) -> DataFrame:
    """The members that change their entry, sent to their new owners."""
    return assigned.where("entry <> nearest").withColumn("entry", F.col("nearest")).repartition("position", "entry", "salt")


def settle(members: DataFrame, books: Codebooks) -> tuple[DataFrame, list[str]]:
    """One assignment: members at their owners, and the paths of the tables to discard in the end."""
    columns = ["id", "position", "entry", "salt", "part"]
    assigned, path = spill(members.mapInArrow(_assign(books), f"{_MEMBER}, nearest int, error long"))
    arrived, other = spill(moved(assigned).select(columns))
    return assigned.where("entry = nearest").select(columns).unionByName(arrived), [path, other]


def digest(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` per vector that can be used."""
    if not 0 < entries <= 256:
        raise ValueError("an index must fit into two hexadecimal digits")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), key_of(label).alias("label"), integers(F.col(vector)).alias("value"))
    # The ids are those of a written table's rows.
    rows = store(store(rows.where("value is not null")).withColumn("id", F.monotonically_increasing_id()))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "value").select(F.size("value").alias("d")).first()
    cuts = bounds(first.d if first else 0, parts)
    usable = rows.where(F.size("value") == cuts[-1])
    books = first_books(usable, cuts, entries)
    salts = max(1, -(-usable.count() // RESIDENT))

    # Members without an owner all move in the first round.
    members, waste = members_of(usable, cuts, salts).withColumn("entry", F.lit(-1)), []
    members = members.select("id", "position", "entry", "salt", "part")
    for _ in range(rounds):
        members, paths = settle(members, books)
        books = updated(books, members)
        waste.append(paths)
        # A state's files are read by the next one, which is written now.
        discard(rows.sparkSession, *(p for old in waste[:-1] for p in old))
        del waste[:-1]
    placed = members.mapInArrow(_assign(books), f"{_MEMBER}, nearest int, error long")
    digits = F.lpad(F.lower(F.hex("nearest")), 2, "0")
    code = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", digits.alias("digits")))), lambda x: x["digits"]), "")
    codes = store(placed.groupBy("id").agg(code.alias("code"), F.sum("error").alias("error")))
    discard(rows.sparkSession, *(p for old in waste for p in old))

    known = store(rows.select("id", "vec_id", "label").join(codes, "id", "left"))
    by_label = store(known.groupBy("label").agg(F.sum("error").alias("label_error")))
    summed = join_measured(known, by_label, "label").withColumn("codebooks_sha256", F.lit(digest(books)))
    return summed.select("vec_id", "code", "error", F.when(F.col("error").isNotNull(), F.col("label_error")).alias("label_error"), "codebooks_sha256")


def _oracle() -> str:
    """Lloyd rounds in SQL, a row per component."""
    book = "SELECT part, entry, pos, x FROM parts JOIN starts USING (vec_id)"
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""
book{k} AS ({book}),
far{k} AS (SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d FROM parts p JOIN book{k} b USING (part, pos) GROUP BY ALL),
near{k} AS (SELECT vec_id, part, min(d) AS d, arg_min(entry, d * {ENTRIES} + entry) AS entry FROM far{k} GROUP BY ALL),
mean{k} AS (
  SELECT part, entry, pos, sum(x) AS s, count(*) AS n, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
  FROM parts JOIN near{k} USING (vec_id, part) GROUP BY part, entry, pos)""")
        book = f"SELECT part, entry, pos, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (part, entry, pos)"
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
wide AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS k, len(embedding) // {PARTS} AS size FROM kept),
parts AS (SELECT vec_id, k // size AS part, k % size AS pos, floor({SCALE} * v::DOUBLE)::BIGINT AS x FROM wide),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
{",".join(steps)},
codes AS (SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (vec_id) CROSS JOIN books
"""


ORACLE = _oracle()
