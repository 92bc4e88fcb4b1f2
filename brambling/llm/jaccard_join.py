"""Similarity self-join of documents on word shingles with a token-group matrix.

A document is the set of its distinct shingles of ``SHINGLE`` words, each as a 64-bit hash. Documents
with equal sets are one class. Two classes link when 100 * |A and B| >= PERCENT * |A or B|.

1. Shingles that many documents share are counted first; they come last in the order of shingles,
   all others are ordered by hash. What is frequent only orders the work; results do not depend on it.
2. Classes are partitioned into groups: by their smallest hash, large groups into blocks of bounded
   size, or of two members on average where texts are longer than that. All links inside a block are
   followed, and one member per block then stands for it in the next level. A second pass does so with
   one member per label, which is what is connected so far, and ``KEYS`` keys of two independent
   smallest hashes each. Labels that still share a key form a group of the matrix: members of one
   family of near copies, whether they link or not. Groups come from an edge per key and label to the
   smallest label of the key, never from pairs.
3. The members of a group are compared in tiles, those of its largest label with all others only.
4. The matrix has a row (shingle, group, smallest and largest set of the group with it): the union of
   the first shingles, in the order, of the group's sets. Two sets that link share at least
   ``least_first`` of their first |A| - ceil(PERCENT/100 |A|) + ``least_first`` shingles, a share of the
   smaller set, so a query whose first shingles are in fewer other groups than that has no link
   elsewhere, and it leaves the matrix before anything is paired. For the queries that remain, the
   overlap with a group's union bounds whether any member can link. Groups below the bound stay closed.
5. For each pair of groups that is opened, the members in question are compared. Large sides are cut
   into blocks here too.

Every link between classes is either followed, or inside a group, or in two groups of which one is
opened to the other, so the components are exact. Components come from their edges alone.

Upper-case A-Z is lowered; words are parted by blanks and the control characters 9 to 13. A document
of fewer words than a shingle has its whole sequence as one; without words, or with a null text, it
links with nothing. Rows that share an id are one document to the components. A null id takes no
part and its component is null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from brambling.llm.common import fresh, join_counted, slices, sorted_runs
from brambling.llm.components import connected
from brambling.operators.joins import BROADCAST_BYTES
from brambling.session import cut, discard, spill, store

SHINGLE = 4
PERCENT = 85
# Two sets share one more of their first shingles for each of so many that they have.
EXTRA, PER_EXTRA = 2, 20
# Keys of two smallest hashes each; links of 85 % share one of five with probability 0.998.
KEYS = 5
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
# Shingles counted as frequent: at least so often, and at most so many of them.
FREQUENT, FREQUENT_MOST = 32, 1 << 18
SUMMARY = 1 << 18
RUN_BYTES = 4 << 20
CACHE = 150_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct shingle hashes of texts, remembering the hashes of words up to a bound."""

    def __init__(self, width: int) -> None:
        self.width, self.known = width, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(_LOWER).split()
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        if not width:
            return np.zeros(0, np.uint64)
        out = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            out = out * _A + h[k : len(h) - width + 1 + k]
        return np.unique(_mixed(out))


def least_overlap(n: int, percent: int) -> int:
    """A set that links with one of ``n`` shares at least so many of them."""
    return -(-percent * n // 100)


def least_first(n: int) -> int:
    """So many of the first shingles two linked sets share, the smaller of which has ``n``, if they share so many at all."""
    return 1 + EXTRA + n // PER_EXTRA


_ODD = (_mixed(np.arange(1, 2 * KEYS + 1, dtype=np.uint64) * _A) | np.uint64(1))[:, None]
KEY_BLOCK = 1 << 16


def family_keys(shingles: np.ndarray) -> np.ndarray:
    """``KEYS`` keys that sets of a high similarity have in common with a probability of its square."""
    # Shingles are mixed numbers, so a product with an odd number orders them anew.
    blocks = [(shingles[k : k + KEY_BLOCK] * _ODD).min(axis=1) for k in range(0, len(shingles), KEY_BLOCK)]
    least = np.min(blocks, axis=0)
    return _mixed(_mixed(least[::2]) * _A + least[1::2] + np.arange(KEYS, dtype=np.uint64)).view(np.int64)


def _frequent(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Shingles that come again within a run of documents, with counts, at most ``SUMMARY`` a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, texts in slices(batches, "text", RUN_BYTES):
            own, n = np.unique(np.concatenate([shingler(t) for t in texts]), return_counts=True)
            again = n > 1
            keys, back = np.unique(np.concatenate([keys, own[again]]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n[again]]), len(keys)).astype(np.int64)
            if len(keys) > SUMMARY:
                top = np.argsort(-counts, kind="stable")[: SUMMARY // 2]
                top.sort()
                keys, counts = keys[top], counts[top]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["shingle", "n"])

    return count


def frequent_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and the powers of two of their counts; at most ``FREQUENT_MOST``."""
    sums = docs.select("text").mapInArrow(_frequent(width), "shingle long, n long")
    power = F.floor(F.log2("n")).cast("int")
    sums, path = spill(sums.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).withColumn("power", power))
    by_power = {r.power: r["count"] for r in sums.groupBy("power").count().collect()}
    least, kept = max(by_power, default=0), 0
    for power in sorted(by_power, reverse=True):
        kept += by_power[power]
        if kept > FREQUENT_MOST:
            break
        least = power
    table = sums.where(F.col("power") >= least).limit(FREQUENT_MOST).select("shingle", "power").toArrow()
    discard(docs.sparkSession, path)
    keys, powers = (np.asarray(table.column(k).combine_chunks()) if table.num_rows else np.zeros(0, np.int64) for k in (0, 1))
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], powers[order]


def first_shingles(shingles: np.ndarray, keys: np.ndarray, powers: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The first shingles of a sorted set in the order of rarity, and the key of its group."""
    n = len(shingles)
    size = min(n, n - least_overlap(n, percent) + least_first(n))
    power = np.zeros(n, np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        power = np.where(keys[at] == shingles, powers[at], 0)
    order = np.argsort(power, kind="stable") if power.any() else np.arange(n)
    rare = power == 0
    basis = shingles[rare] if 2 * rare.sum() >= n else shingles[~rare]
    return shingles[order[:size]], int(_mixed(basis).min().view(np.int64))


def _signatures(width: int, percent: int, keys: np.ndarray, powers: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch, texts in slices(batches, "text", RUN_BYTES):
            n, f, g, group, firsts, keyed = [], [], [], [], [], []
            for text in texts:
                shingles = shingler(text)
                n.append(len(shingles))
                digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
                f.append((digest >> 64) - (1 << 63))
                g.append((digest & ((1 << 64) - 1)) - (1 << 63))
                first, key = first_shingles(shingles, keys, powers, percent) if len(shingles) else (shingles, 0)
                group.append(key)
                firsts.append(first.view(np.int64))
                keyed.append(family_keys(shingles) if len(shingles) else np.zeros(KEYS, np.int64))
            ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(firsts)))
            families = pa.ListArray.from_arrays(pa.array(np.arange(0, KEYS * len(texts) + 1, KEYS, dtype=np.int32)), pa.array(np.concatenate(keyed)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, f, g, group)), lists, families], names=["doc_id", "n", "f", "g", "gkey", "first", "keys"])

    return sign


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch, texts in slices(batches, "text", RUN_BYTES):
            sets = pa.array([shingler(t).tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("tiles"), sets], names=["rep", "tiles", "shingles"])

    return load


_TILE = ("ta", "tb", "i", "j")


def _load(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """The whole sets of ``members (rep, ta, tb, i, j, side, label)``, sorted by tile."""
    tiles = members.groupBy("rep").agg(F.collect_list(F.struct(*_TILE, "side", "label")).alias("tiles"))
    n = members.count()
    chosen = F.broadcast(tiles) if n * 64 <= BROADCAST_BYTES else tiles
    rows = docs.join(chosen, docs.doc_id == chosen.rep if n * 64 > BROADCAST_BYTES else F.col("doc_id") == F.col("rep")).select("rep", "tiles", "text")
    loaded = rows.mapInArrow(_sets(width), "rep long, tiles array<struct<ta:long,tb:long,i:int,j:int,side:boolean,label:long>>, shingles binary")
    each = loaded.select("rep", F.explode("tiles").alias("t"), "shingles").select("rep", "t.*", "shingles")
    return each.repartition(*_TILE).sortWithinPartitions(*_TILE)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    def chunks() -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                sets = np.empty(part.num_rows, object)
                sets[:] = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
                yield {k: np.asarray(part.column(k)) for k in ("rep", "label", *_TILE)} | {"side": part.column("side").to_numpy(zero_copy_only=False), "sets": sets}

    return sorted_runs(chunks(), list(_TILE))


class _Sets:
    """Overlaps of one set with many."""

    def __init__(self, sets: np.ndarray):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.start = np.cumsum(self.size) - self.size
        _, self.code = np.unique(np.concatenate(list(sets)), return_inverse=True)
        self.mark = np.zeros(int(self.code.max()) + 1, bool)

    def codes(self, k: int) -> np.ndarray:
        return self.code[self.start[k] : self.start[k] + self.size[k]]

    def linked(self, one: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Those of ``others`` that link with ``one``."""
        a, b = self.size[one], self.size[others]
        others = others[(100 * b >= percent * a) & (100 * a >= percent * b)]
        if not len(others):
            return others
        mine = self.codes(one)
        self.mark[mine] = True
        size = self.size[others]
        starts = np.cumsum(size) - size
        places = np.repeat(self.start[others] - starts, size) + np.arange(int(size.sum()))
        common = np.add.reduceat(self.mark[self.code[places]].astype(np.int64), starts)
        self.mark[mine] = False
        return others[100 * common >= percent * (a + size - common)]


def _inside(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Components inside each block: ``(rep, root, pivot, gkey)``; pivot marks the root of the largest."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            reps, sets = run["rep"], _Sets(run["sets"])
            left = np.arange(len(reps))
            root = np.zeros(len(reps), np.int64)
            largest, pivot = 0, 0
            while len(left):
                component, queue, left = [int(left[0])], [int(left[0])], left[1:]
                while queue and len(left):
                    new = sets.linked(queue.pop(), left, percent)
                    if len(new):
                        left = np.setdiff1d(left, new, assume_unique=True)
                        component += new.tolist()
                        queue += new.tolist()
                root[component] = reps[component].min()
                if len(component) > largest:
                    largest, pivot = len(component), root[component[0]]
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(root), pa.array(reps == pivot), pa.array(run["ta"])], names=["rep", "root", "pivot", "gkey"])

    return follow


def _across(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links between groups, one for each two that any links in a tile: ``(rep, root)``.

    Members on different sides are compared unless their groups are connected already; in the tile
    of a cluster's block with itself all members are.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            reps, side, inside = run["rep"], run["side"], run["ta"][0] == run["tb"][0] and run["i"][0] == run["j"][0]
            _, root = np.unique(run["label"], return_inverse=True)
            if root.max() == 0 or not (inside or (side.any() and not side.all())):
                continue
            sets = _Sets(run["sets"])
            few = np.arange(len(reps)) if inside else np.flatnonzero(side == (2 * side.sum() <= len(side)))
            left, right = [], []
            for one in few:
                others = root != root[one]
                if inside:
                    others[:one] = False
                else:
                    others &= side != side[one]
                new = sets.linked(int(one), np.flatnonzero(others), percent)
                for other in new:
                    if root[other] != root[one]:
                        left.append(reps[one])
                        right.append(reps[other])
                        root[root == root[other]] = root[one]
                if len(new) and (root == root[0]).all():
                    break
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["rep", "root"])

    return search


def _blocks(rows: Column, shingles: Column) -> Column:
    """Into how many blocks so many members with so many shingles in all are cut."""
    return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _grouped_edges(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Step 2: edges ``(rep, root)`` found inside the groups."""
    total = max(1, classes.count())
    members = classes.select("gkey", "rep", "n")
    edges = None
    while True:
        sizes = members.groupBy("gkey").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1")
        # With two members a block on average a round leaves at most half of a group, however long its texts are.
        blocks = F.greatest(F.lit(1), F.least(_blocks(F.col("size"), F.col("shingles")), F.floor(F.col("size") / 2))).cast("int")
        sizes = cut(sizes.select("gkey", "size", blocks.alias("blocks")))
        if sizes.isEmpty():
            return edges
        placed = join_counted(members, sizes, ["gkey"], "size", total)
        block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("long")
        zero = F.lit(0).cast("int")
        tiles = placed.select("rep", F.col("gkey").alias("ta"), block.alias("tb"), zero.alias("i"), zero.alias("j"), F.lit(True).alias("side"), F.lit(0).cast("long").alias("label"))
        found = store(_load(docs, tiles, width).mapInArrow(_inside(percent), "rep long, root long, pivot boolean, gkey long"))
        own = found.where("rep <> root").select("rep", "root")
        edges = own if edges is None else edges.unionByName(own)
        many = sizes.where("blocks > 1").select("gkey")
        # One row per block, of groups with several blocks only.
        pivots = found.where("pivot").join(many, "gkey", "left_semi").dropDuplicates(["gkey", "rep"])
        members = store(pivots.join(classes.groupBy("rep").agg(F.max("n").alias("n")), "rep").select("gkey", "rep", "n"))


def _least_shared(n: str, percent: int) -> Column:
    """``least_first`` of a number of shingles, or all that a link needs where these are fewer."""
    return F.least(F.lit(1 + EXTRA) + F.floor(F.col(n) / PER_EXTRA), F.ceil(F.col(n) * percent / 100))


def _elsewhere(entries: DataFrame, column: str) -> DataFrame:
    """The entries whose shingle has another value of ``column`` too; by one exchange, and none if they are dealt by shingle."""
    own = Window.partitionBy("shingle")
    both = entries.withColumns({"_low": F.min(column).over(own), "_high": F.max(column).over(own)})
    return both.where("_low <> _high").drop("_low", "_high")


def _opened(classes: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """Step 4: ``(rep, n, group, other)`` for the groups that a set may link into."""
    common = _elsewhere(classes.select("rep", F.explode("first").alias("shingle")), "rep")
    shared = store(_elsewhere(store(common).join(grouped.select("rep", "n", "group"), "rep"), "group"))
    # The other set of a link has PERCENT of this one's shingles at least.
    fewest = shared.groupBy("rep", "n").agg(F.count("*").alias("common")).withColumn("low", F.ceil(F.col("n") * percent / 100))
    able = store(fewest.where(F.col("common") >= _least_shared("low", percent)).select("rep"))
    rest = shared.join(able, "rep", "left_semi").repartition("shingle")
    # The last column makes both sides of the join read one exchange.
    matrix = rest.groupBy("shingle", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("rep").alias("any"))
    matrix = matrix.select("shingle", F.col("group").alias("other"), "low", "high", "any")
    sizes = (F.col("high") * 100 >= F.col("n") * percent) & (F.col("low") * percent <= F.col("n") * 100)
    hits = rest.join(matrix, "shingle").where((F.col("group") != F.col("other")) & sizes & F.col("any").isNotNull())
    overlap = hits.groupBy("rep", "n", "group", "other").agg(F.count("*").alias("common"), F.min("low").alias("low"))
    least = F.least(_least_shared("n", percent), _least_shared("low", percent))
    return overlap.where(F.col("common") >= least).select("rep", "n", "group", "other")


def _in_groups(grouped: DataFrame) -> DataFrame:
    """Step 3: tiles of the groups that have several labels; blocks of the largest label come after all others."""
    members = grouped.select("rep", "n", "label", "group")
    labels = members.groupBy("group", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    own = lambda name, main: F.sum(F.when((F.col("label") == F.col("main")) == F.lit(main), F.col(name)).otherwise(0))
    main = labels.groupBy("group").agg(F.max_by("label", F.struct("rows", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    sizes = labels.join(main, "group").groupBy("group", "main").agg(
        F.sum("rows").alias("rows"), _blocks(own("rows", False), own("shingles", False)).alias("others"), _blocks(own("rows", True), own("shingles", True)).alias("mains")
    )
    placed = join_counted(members, store(sizes), ["group"], "rows", max(1, members.count()))
    is_main, hashed = F.col("label") == F.col("main"), F.xxhash64("rep")
    mine = F.when(is_main, F.col("others") + F.pmod(hashed, F.col("mains"))).otherwise(F.pmod(hashed, F.col("others"))).cast("int")
    reach = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")).cast("int")
    placed = placed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), reach - 1)))
    i, j = F.least("mine", "other"), F.greatest("mine", "other")
    return placed.select("rep", F.col("group").alias("ta"), F.col("group").alias("tb"), i.alias("i"), j.alias("j"), (F.col("mine") == i).alias("side"), "label")


def _between_groups(opened: DataFrame, labels: DataFrame) -> DataFrame:
    """Step 5: tiles of the pairs of groups that one opens to the other."""
    ta, tb = F.least("group", "other"), F.greatest("group", "other")
    rows = opened.select("rep", "n", ta.alias("ta"), tb.alias("tb"), (F.col("group") == ta).alias("side"))
    own = lambda side, value: F.sum(F.when(F.col("side") == side, value).otherwise(0))
    sizes = rows.groupBy("ta", "tb").agg(
        F.count("*").alias("size"), own(True, 1).alias("na"), own(True, F.col("n")).alias("sa"), own(False, 1).alias("nb"), own(False, F.col("n")).alias("sb")
    )
    # A group may be opened from one side alone; then no member of the other can link.
    sizes = sizes.where("na > 0 and nb > 0").withColumns({"ba": _blocks(F.col("na"), F.col("sa")), "bb": _blocks(F.col("nb"), F.col("sb"))})
    placed = join_counted(rows, store(sizes.select("ta", "tb", "size", "ba", "bb")), ["ta", "tb"], "size", max(1, opened.count()))
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("side"), F.col("ba")).otherwise(F.col("bb"))).cast("int")
    placed = placed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("side"), F.col("bb")).otherwise(F.col("ba")) - 1)))
    i, j = (F.when(F.col("side"), F.col(a)).otherwise(F.col(b)) for a, b in (("mine", "other"), ("other", "mine")))
    return placed.select("rep", "ta", "tb", i.alias("i"), j.alias("j"), "side").join(labels, "rep")


def _crossing_edges(docs: DataFrame, classes: DataFrame, labels: DataFrame, width: int, percent: int) -> DataFrame:
    """Steps 3 to 5: edges ``(rep, root)`` between labels."""
    stars = connected(_stars(classes, labels), "label", "least").withColumnsRenamed({"node": "label", "component": "group"})
    grouped = store(labels.join(stars, "label", "left").withColumn("group", F.coalesce("group", "label")))
    opened = store(_opened(classes, grouped, percent))
    tiles = _in_groups(grouped).unionByName(_between_groups(opened, labels.select("rep", "label")))
    return store(_load(docs, store(tiles), width).mapInArrow(_across(percent), "rep long, root long"))


def _keyed(classes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(key, label, rep, n)``, one member per key and label, and ``(key, least, rows)`` of the keys that several labels have."""
    each = classes.select("rep", F.explode("keys").alias("key")).join(labels, "rep").groupBy("key", "label")
    keyed = store(each.agg(F.min(F.struct("rep", "n")).alias("m")).select("key", "label", "m.rep", "m.n"))
    return keyed, keyed.groupBy("key").agg(F.min("label").alias("least"), F.count("*").alias("rows")).where("rows > 1")


def _stars(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(label, least)``: from each label to the smallest one that shares a key with it."""
    keyed, several = _keyed(classes, labels)
    return join_counted(keyed.select("key", "label"), several, ["key"], "rows", max(1, keyed.count())).where("label <> least").select("label", "least")


def _families(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(gkey, rep, n)``: one member per key and label, of the keys that several labels have."""
    keyed, several = _keyed(classes, labels)
    return store(join_counted(keyed, several.drop("least"), ["key"], "rows", max(1, keyed.count())).select(F.col("key").alias("gkey"), "rep", "n"))


def _labels(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(rep, n, label)``: the component of each class by ``edges (rep, root)``."""
    component = connected(edges, "rep", "root")
    return store(classes.select("rep", "n").join(component, F.col("rep") == F.col("node"), "left").select("rep", "n", F.coalesce("component", "rep").alias("label")))


def _same_id(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges ``(rep, root)`` from an id to the classes of its rows, where these differ in their sets."""
    own, known = F.struct("f", "g"), signed.where("doc_id is not null")
    ids = known.groupBy("doc_id").agg(F.min(own).alias("least"), F.max(own).alias("most")).where("least <> most").select("doc_id")
    rows = store(known.join(ids, "doc_id", "left_semi").select("doc_id", "f", "g").distinct())
    return rows.join(classes.select("f", "g", "rep"), ["f", "g"]).select(F.col("doc_id").alias("rep"), F.col("rep").alias("root"))


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys, powers = frequent_shingles(texts, width)
    signed = store(texts.mapInArrow(_signatures(width, percent, keys, powers), "doc_id long, n long, f long, g long, gkey long, first array<long>, keys array<long>"))
    usable = signed.where("n > 0 and doc_id is not null")
    classes = store(
        usable.groupBy("f", "g").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("gkey").alias("gkey"), F.first("first").alias("first"), F.first("keys").alias("keys"))
    )
    none = classes.select("rep", F.col("rep").alias("root")).where(F.lit(False))
    edges = _grouped_edges(texts, classes, width, percent) or none
    labels = _labels(classes, edges)
    again = _grouped_edges(texts, _families(classes, labels), width, percent)
    if again is not None:
        edges = edges.unionByName(again)
        labels = _labels(classes, edges)
    crossing = _crossing_edges(texts, classes, labels, width, percent)
    joined = labels.where("rep <> label").select("rep", F.col("label").alias("root"))
    every = joined.unionByName(crossing).unionByName(_same_id(signed, classes))
    component = connected(every, "rep", "root")
    final = classes.join(component, F.col("rep") == F.col("node"), "left")
    final = store(final.select("f", "g", "copies", F.coalesce("component", "rep").alias("component_id")))
    rows = usable.select("doc_id", "n", "f", "g")
    joined = join_counted(rows, final, ["f", "g"], "copies", max(1, rows.count()))
    alone = signed.where("n = 0 or doc_id is null").join(component, F.col("doc_id") == F.col("node"), "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component_id"))
    return joined.select("doc_id", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles")


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns.

    Of rows that repeat that id, which are one document, the first by text stays, then by the other
    columns that have an order; rows without id stay as they are.
    """
    groups, name = similar_documents(docs, doc_id=doc_id, text=text, **options), fresh("_gone", docs.columns)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    kept = docs.where(F.col(doc_id).isNotNull()).join(gone, F.col(doc_id) == F.col(name), "left_anti")
    order = F.struct(F.col(text), *(F.col(f"`{f.name}`") for f in docs.schema if f.name not in (doc_id, text) and _ordered(f.dataType)))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    once = kept.groupBy(F.col(doc_id).alias(name)).agg(F.min_by(row, order).alias("row")).select("row.*")
    return once.unionByName(docs.where(F.col(doc_id).isNull()))


ORACLE = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' '))) AS s
  FROM texts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= {PERCENT} * (x.n + y.n - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM texts UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a)
SELECT t.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id
FROM texts t LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
