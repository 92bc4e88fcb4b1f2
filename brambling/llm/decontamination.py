"""Benchmark decontamination with an FM-index per shard of training documents.

The words of a benchmark item are cut into windows of ``WINDOW`` consecutive words; an item of fewer
words, but not none, is one window. A task takes its documents in shards of bounded size and builds
an index of each: the suffixes of the shard's word sequence are sorted, the word before each suffix
gives the transformed sequence, and a wavelet matrix over it answers how often a word occurs before
a place. All windows are searched backward at once; their occurrences are located by stepping to the
nearest suffix whose position was kept, and merged into spans of hit words per document. Words that
no item has end a run, and runs shorter than the shortest window hold no occurrence, so neither is
put into the index.

Items are sent to the tasks in blocks of bounded size; more blocks mean more passes over the
documents, each adding to the spans found so far. Between passes the rows are in the shared folder, so
the driver holds one block at a time.

Upper-case A-Z is lowered; words are runs of digits, a-z and characters beyond ASCII. A null text
has no words, and a document without words is not contaminated. Items without id or words take no
part; rows that repeat an item's id count as one item with the windows of all. Repeated documents get
equal results; empty tables give no rows or no hits. Columns that are not named are ignored or kept
as ``keep`` says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brambling.llm.common import fresh, slices
from brambling.session import discard, spill

WINDOW = 13
SAMPLE_RATE = 8
SHARD_BYTES = 8 << 20
PIECE_BYTES = 4 << 20
ITEM_BYTES = 16 << 20

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    plain = text.translate(_WORD)
    first = 0
    while first < len(plain):
        last = len(plain)
        if last - first > PIECE_BYTES:
            last = plain.find(b" ", first + PIECE_BYTES)
            last = len(plain) if last < 0 else last
        yield plain[first:last].split()
        first = last


def _places(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...``, ``count[i]`` of them, for each i in turn."""
    return np.arange(int(count.sum())) + np.repeat(start - np.cumsum(count) + count, count)


def _names(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Numbers that are equal where the ``width`` words from these places on are.

    Runs of 1, 2, 4, ... words are numbered from two halves each; a window is made of such runs.
    """
    run, step, taken = words.astype(np.int64), 1, 0
    out = np.zeros(len(at), np.int64)
    while step <= width:
        if width & step:
            out = np.unique(out * (int(run.max(initial=0)) + 1) + run[at + taken], return_inverse=True)[1]
            taken += step
        after = np.zeros_like(run)
        after[:-step] = run[step:]
        run = np.unique(run * (int(run.max(initial=0)) + 1) + after, return_inverse=True)[1]
        step *= 2
    return out


@dataclass
class Windows:
    """The distinct windows of a block of items, each as a place in the items' words.

    This is what travels with a job: 16 bytes per word of the items and their distinct words.
    """

    distinct: bytes  # the distinct words, numbered from 1 in this order
    words: np.ndarray  # numbers of all items' words, one item after another
    first: np.ndarray  # place of each window, those of ``width`` words before the shorter ones
    width: int
    short: np.ndarray  # lengths of the shorter windows
    names: list[str]
    owner: np.ndarray  # the items of each window, as places in ``names``
    bounds: np.ndarray  # and where those of a window start

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], width: int) -> Windows:
        vocabulary: dict[bytes, int] = {}
        names: dict[str, int] = {}
        parts, owner = [np.zeros(0, np.int32)], []
        for item, text in items:
            number = lambda w: vocabulary.setdefault(w, len(vocabulary) + 1)
            own = [np.fromiter(map(number, words), np.int32, len(words)) for words in words_of(text)]
            parts.append(np.concatenate([parts[0], *own]))
            owner.append(names.setdefault(item, len(names)))
        words, sizes = np.concatenate(parts), np.array([len(x) for x in parts[1:]], np.int64)
        start, owner = np.cumsum(sizes) - sizes, np.array(owner, np.int64)

        count = np.maximum(sizes - width + 1, 0)
        at = _places(start, count)
        _, first, window = np.unique(_names(words, at, width), return_index=True, return_inverse=True)
        first, owner_of = at[first], np.repeat(owner, count)
        brief = np.flatnonzero((sizes > 0) & (sizes < width))
        found: dict[bytes, int] = {}
        own = [found.setdefault(words[start[i] : start[i] + sizes[i]].tobytes(), len(first) + len(found)) for i in brief]
        fresh_ones = brief[np.unique(np.array(own, np.int64), return_index=True)[1]]
        pairs = np.unique(np.concatenate([window, np.array(own, np.int64)]) * max(1, len(names)) + np.concatenate([owner_of, owner[brief]]))
        n = len(first) + len(found)
        bounds = np.searchsorted(pairs // max(1, len(names)), np.arange(n + 1))
        small = lambda x: x.astype(np.int32)
        return cls(b" ".join(vocabulary), words, small(np.concatenate([first, start[fresh_ones]])), width, small(sizes[fresh_ones]), list(names), small(pairs % max(1, len(names))), small(bounds))

    def vocabulary(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.distinct.split(), 1)}

    @property
    def length(self) -> np.ndarray:
        return np.concatenate([np.full(len(self.first) - len(self.short), self.width, np.int64), self.short])

    def items(self, window: int) -> list[str]:
        return [self.names[i] for i in self.owner[self.bounds[window] : self.bounds[window + 1]]]


class Wavelet:
    """Ranks in a sequence of small numbers: bits from the highest down, each level stably parted."""

    def __init__(self, sequence: np.ndarray, largest: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bit = (sequence >> shift & 1).astype(bool)
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.levels.append((shift, ones, len(sequence) - int(ones[-1])))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        start = np.zeros_like(place)
        for shift, ones, zeros in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            place = np.where(one, zeros + ones[place], place - ones[place])
            start = np.where(one, zeros + ones[start], start - ones[start])
        return place - start


class Index:
    """FM-index of a sequence of runs; 0 ends each run and the whole."""

    def __init__(self, sequence: np.ndarray, largest: int):
        n = len(sequence)
        ends = sequence == 0
        # Every end differs from all others and is smaller than any word, so suffixes differ by the
        # end of their run.
        rank = np.where(ends, np.cumsum(ends) - 1, sequence + int(ends.sum()))
        step = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            step *= 2
            if fresh[-1] == n - 1 or step >= n:
                break
        self.before = sequence[order - 1]  # the word before each suffix; 0 before the first
        self.wavelet = Wavelet(self.before, largest)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=largest + 1))])
        # Positions are kept at every SAMPLE_RATE-th place and at the start of each run.
        self.kept = (order % SAMPLE_RATE == 0) | (self.before == 0)
        self.kept_rank = np.cumsum(self.kept) - 1
        self.positions = order[self.kept]

    def _back(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.wavelet.rank(symbol, place)

    def search(self, words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that start with the ``length`` words from each place ``first``."""
        low, high = np.zeros(len(first), np.int64), np.full(len(first), len(self.before), np.int64)
        for k in range(int(length.max()) - 1, -1, -1):
            on = np.flatnonzero((k < length) & (low < high))
            symbol = words[first[on] + k]
            low[on], high[on] = self._back(symbol, low[on]), self._back(symbol, high[on])
        return low, high

    def locate(self, place: np.ndarray) -> np.ndarray:
        """The positions in the sequence of the suffixes at these places."""
        out = np.zeros(len(place), np.int64)
        steps, open_ = 0, np.arange(len(place))
        while len(open_):
            done = self.kept[place]
            out[open_[done]] = self.positions[self.kept_rank[place[done]]] + steps
            place, open_ = place[~done], open_[~done]
            place = self._back(self.before[place], place)
            steps += 1
        return out


def occurrences(docs: list[np.ndarray], windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """``(place, window)`` of every occurrence, places counting words through all ``docs``.

    A document is an array of word numbers, 0 for words that no item has.
    """
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not docs or not len(windows.first):
        return nothing
    zero = np.zeros(1, np.int64)
    whole = np.concatenate([x for d in docs for x in (d, zero)])
    words = np.concatenate([np.full(len(d) + 1, k) for k, d in enumerate(docs)])
    known = whole > 0
    edges = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    lengths = windows.length
    long = ends - starts >= lengths.min()
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return nothing
    sizes = ends - starts + 1  # a run and the word that ends it
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    source = shift + np.arange(len(shift))
    index = Index(np.where(known[source], whole[source], 0), int(windows.words.max()))
    low, high = index.search(windows.words, windows.first, lengths)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    place = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(window))
    at = source[index.locate(place)]
    return at - words[at], window


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


_FOUND = T.StructType([T.StructField("words", T.LongType()), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])


def _pass(windows: Windows, names: list[str], text_name: str, found_name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Search one block of items; adds to what earlier passes found."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, lengths = windows.vocabulary(), windows.length
        for batch, texts in slices(batches, text_name, SHARD_BYTES):
            docs = []
            for text in texts:
                parts = [np.fromiter((number.get(w, 0) for w in words), np.int64, len(words)) for words in words_of(text)]
                docs.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            place, window = occurrences(docs, windows)
            bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
            change = np.zeros(bounds[-1] + 1, np.int64)
            np.add.at(change, place, 1)
            np.add.at(change, place + lengths[window], -1)
            hit = np.cumsum(change) > 0
            owner = np.searchsorted(bounds, place, side="right") - 1
            found: dict[int, set[str]] = {}
            for doc, w in set(zip(owner.tolist(), window.tolist())):
                found.setdefault(doc, set()).update(windows.items(w))
            rows = []
            for k, old in enumerate(batch.column(found_name).to_pylist()):
                own = hit[bounds[k] : bounds[k + 1]].copy()
                for a, b in zip(old["starts"], old["ends"]):
                    own[a:b] = True
                spans = _spans(own) if own.any() else []
                rows.append({"words": len(own), "starts": [a for a, _ in spans], "ends": [b for _, b in spans], "items": sorted({*old["items"], *found.get(k, ())})})
            columns = [batch.column(i) for i in range(len(names))]
            columns.append(pa.array(rows, batch.schema.field(found_name).type))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, found_name])

    return search


def find(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, found: str = "_found") -> DataFrame:
    """The columns ``keep`` and ``found``: the number of words, the hit spans, and the items.

    Spans count words from 0, their end is exclusive; items are the ids as text.
    """
    # A text that is kept goes to Python once.
    own = text if text in keep else fresh("_text", [*keep, found])
    names = keep if text in keep else [*keep, own]
    usable = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull())
    usable = usable.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    total = usable.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    empty = F.struct(F.lit(0).cast("long").alias("words"), F.array().cast("array<bigint>").alias("starts"), F.array().cast("array<bigint>").alias("ends"), F.array().cast("array<string>").alias("items"))
    more = [] if text in keep else [F.col(f"`{text}`").alias(own)]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *more, empty.alias(found))
    schema = T.StructType([*rows.schema.fields[: len(names)], T.StructField(found, _FOUND)])
    path = None
    for k in range(blocks):
        # About ITEM_BYTES of items at a time.
        some = [(r.item, r.text.encode()) for r in usable.where(block == k).distinct().collect()]
        rows = rows.mapInArrow(_pass(Windows.of(some, width), names, own, found), schema)
        if k < blocks - 1:
            before = path
            rows, path = spill(rows)
            if before:
                discard(docs.sparkSession, before)
    return rows.select(*[F.col(f"`{c}`") for c in keep], found)


def n_hit(found: str = "_found") -> Column:
    return F.aggregate(F.zip_with(f"{found}.starts", f"{found}.ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)


def contaminated(found: str = "_found") -> Column:
    return (n_hit(found) > 0) & (n_hit(found) * 20 >= F.col(f"{found}.words"))


def digest(found: DataFrame) -> DataFrame:
    items = F.col("_found.items")
    return found.select(
        "doc_id", F.col("_found.words").alias("n_words"), n_hit().alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    name = fresh("_found", docs.columns)
    return find(docs, items, docs.columns, found=name, **options).where(~contaminated(name)).drop(name)


_CUT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_CUT} AS w FROM benchmark WHERE item_id IS NOT NULL),
docs AS (SELECT doc_id, {_CUT} AS w FROM documents),
starts AS (SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM starts),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
hits AS (
  SELECT doc_id, i, p.k, item FROM (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM places) p
  JOIN windows USING (k, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
