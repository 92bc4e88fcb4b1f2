"""Toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of two hashed embeddings, of the word and of its first letters. Filters of
several widths slide over the words, the largest response of each filter over the whole text is kept,
and a logistic unit reads them. The embeddings start from how unevenly documents with and without the
label use a bucket; buckets of fewer than ``MIN_DOCS`` training documents have none. Training is
stochastic gradient descent on all labelled documents but those held back. They are dealt to shards of
about ``SHARD_ROWS`` documents or ``SHARD_BYTES`` of text; in each of ``EPOCHS`` rounds every shard
descends from the same network, and what comes out is averaged: an embedding over the steps that moved
it, all else over the documents. Sums are taken in whole numbers, so their order does not matter. One
document in ``HELD_BACK``, by a hash of its id, is held back to choose a threshold for each language,
drawn to the common one where few are held back, which the score maps to 0.5. The language is the likeliest one by the text's trigrams, learned from all
labelled documents.

Labels of one id are averaged; null labels and ids do not count. A null text is empty; empty texts
get the score of a text without known words. Without positive and negative labels every score is the
mean label, or 0 without any. Repeated rows get equal scores; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import copy
import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.llm import language
from brambling.llm.common import join_measured, slices
from brambling.session import discard, spill

SHARD_ROWS = 6_000
SHARD_BYTES = 48 << 20
BUCKETS = 1 << 18
PREFIX = 5
MIN_DOCS = 3
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
EPOCHS = 4
BATCH = 64
RATE = 0.05
DECAY = 1e-4
SEED = 7
HELD_BACK = 5
# Averages are sums of whole numbers of this part of 1.
UNIT = 2.0**-24
# So many held-back documents with the label weigh as much as the threshold common to all languages.
COMMON = 10
# Steps of the held-back scores, per unit of the logarithm of the odds.
LEVELS = 256
CACHE = 150_000
RUN_BYTES = 4 << 20
PAD = max(WIDTHS)

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Hasher:
    """Buckets of words and of their beginnings, remembered up to a bound."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        """Word bucket times ``BUCKETS`` plus the bucket of the beginning, per word."""
        words = text.translate(_WORD).split()
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh32_intdigest(word) % BUCKETS * BUCKETS + xxhash.xxh32_intdigest(word[:PREFIX], 1) % BUCKETS
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents' words with padding (-1) after each, where each starts, and the places at which
    filters may start: every word, and one place of padding so that no document has none."""
    lengths = np.array([len(d) for d in docs], np.int64) + PAD
    starts = np.cumsum(lengths) - lengths
    flat = np.full(int(lengths.sum()), -1, np.int64)
    usable = np.ones(len(flat), bool)
    for d, a, n in zip(docs, starts, lengths):
        flat[a : a + len(d)] = d
        usable[a + len(d) + 1 : a + n] = False
    return flat, starts, usable


@dataclass
class Net:
    """Rows 0 of the embeddings are zero: padding and buckets without an embedding."""

    word_row: np.ndarray
    prefix_row: np.ndarray
    words: np.ndarray
    prefixes: np.ndarray
    filters: list[np.ndarray]  # per width: width x DIMENSIONS x FILTERS
    bias: np.ndarray
    out: np.ndarray
    base: float
    heavier: float = 1.0  # weight of a document with the label
    squares: dict = field(default_factory=dict)
    moved: dict = field(default_factory=dict)  # per embedding, the steps that moved it

    def rows(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        there = flat >= 0
        safe = np.where(there, flat, 0)
        return self.word_row[safe // BUCKETS] * there, self.prefix_row[safe % BUCKETS] * there

    def responses(self, x: np.ndarray, usable: np.ndarray) -> np.ndarray:
        every = []
        for weight in self.filters:
            total = x @ weight[0]
            for j in range(1, len(weight)):
                total[:-j] += x[j:] @ weight[j]
            every.append(total)
        c = np.hstack(every) + self.bias
        c[~usable] = -np.inf
        return c

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        flat, starts, usable = laid_out(docs)
        a, b = self.rows(flat)
        pooled = np.maximum.reduceat(self.responses(self.words[a] + self.prefixes[b], usable), starts)
        return np.maximum(pooled, 0) @ self.out + self.base

    def _descend(self, name: str, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        squares = self.squares.setdefault(name, np.full(value.shape, 1e-3))
        gradient = gradient + DECAY * value[rows]
        squares[rows] += gradient**2
        value[rows] -= RATE * gradient / np.sqrt(squares[rows])

    def step(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
        flat, starts, usable = laid_out(docs)
        a, b = self.rows(flat)
        x = self.words[a] + self.prefixes[b]
        c = self.responses(x, usable)
        pooled = np.maximum.reduceat(c, starts)
        active = np.maximum(pooled, 0)
        slope = (1 / (1 + np.exp(-np.clip(active @ self.out + self.base, -30, 30))) - y) * weight / len(y)
        # The first place at which each filter responds most.
        doc = np.repeat(np.arange(len(docs)), np.diff(np.append(starts, len(flat))))
        place, column = np.nonzero(c == pooled[doc])
        _, first = np.unique(doc[place] * c.shape[1] + column, return_index=True)
        place, column = place[first], column[first]
        down = slope[doc[place]] * self.out[column] * (pooled[doc[place], column] > 0)
        to_x = np.zeros((0, DIMENSIONS))
        at = np.zeros(0, np.int64)
        gradients = [np.zeros_like(w) for w in self.filters]
        for k, weight_k in enumerate(self.filters):
            own = column // FILTERS == k
            p, f, g = place[own], column[own] % FILTERS, down[own]
            for j in range(len(weight_k)):
                np.add.at(gradients[k][j].T, f, x[p + j] * g[:, None])
                to_x = np.vstack([to_x, weight_k[j].T[f] * g[:, None]])
                at = np.concatenate([at, p + j])
        bias = np.bincount(column, down, len(self.bias))
        for name, value, rows in (("words", self.words, a[at]), ("prefixes", self.prefixes, b[at])):
            unique, back = np.unique(rows, return_inverse=True)
            total = np.zeros((len(unique), DIMENSIONS))
            np.add.at(total, back, to_x)
            total[unique == 0] = 0
            self.moved.setdefault(name, np.zeros(len(value), np.int64))[unique] += 1
            self._descend(name, value, total, unique)
            value[0] = 0
        for k, gradient in enumerate(gradients):
            self._descend(f"filters{k}", self.filters[k], gradient)
        self._descend("bias", self.bias, bias)
        self._descend("out", self.out, active.T @ slope)
        self.base -= RATE * float(slope.sum())


    def learn(self, docs: list[np.ndarray], y: np.ndarray, rounds: int, rng: np.random.Generator) -> None:
        weight = np.where(y > 0.5, self.heavier, 1.0)
        for _ in range(rounds):
            order = rng.permutation(len(docs))
            for k in range(0, len(order), BATCH):
                some = order[k : k + BATCH]
                self.step([docs[i] for i in some], y[some], weight[some])

    def _dense(self) -> tuple[np.ndarray, np.ndarray]:
        """All parameters but the embeddings, and their summed squares, as rows of ``DIMENSIONS`` numbers."""
        named = {**{f"filters{k}": w for k, w in enumerate(self.filters)}, "bias": self.bias, "out": self.out}
        values = np.concatenate([*(v.ravel() for v in named.values()), [self.base]])
        squares = np.concatenate([*(self.squares.get(name, np.full(v.shape, 1e-3)).ravel() for name, v in named.items()), [0.0]])
        more = -len(values) % DIMENSIONS
        return tuple(np.pad(x, (0, more)).reshape(-1, DIMENSIONS) for x in (values, squares))

    def changes(self, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, weights, and parameters with their summed squares of what ``docs`` documents moved."""
        keys, weights, rows, first = [], [], [], 0
        for name, value in (("words", self.words), ("prefixes", self.prefixes)):
            moved = self.moved.get(name, np.zeros(len(value), np.int64))
            at = np.flatnonzero(moved)
            keys.append(first + at)
            weights.append(moved[at])
            rows.append(np.hstack([value[at], self.squares[name][at]]) if len(at) else np.zeros((0, 2 * DIMENSIONS)))
            first += len(value)
        dense = np.hstack(self._dense())
        keys.append(first + np.arange(len(dense)))
        weights.append(np.full(len(dense), docs))
        return np.concatenate(keys), np.concatenate(weights), np.vstack([*rows, dense])

    def put(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Take averaged ``changes``."""
        first = 0
        for name, value in (("words", self.words), ("prefixes", self.prefixes)):
            own = (keys >= first) & (keys < first + len(value))
            at = keys[own] - first
            value[at] = rows[own, :DIMENSIONS]
            self.squares.setdefault(name, np.full(value.shape, 1e-3))[at] = rows[own, DIMENSIONS:]
            first += len(value)
        own = np.flatnonzero(keys >= first)
        own = own[np.argsort(keys[own])]
        values, squares = rows[own, :DIMENSIONS].ravel(), rows[own, DIMENSIONS:].ravel()
        at = 0
        for name, value in [*((f"filters{k}", w) for k, w in enumerate(self.filters)), ("bias", self.bias), ("out", self.out)]:
            span = slice(at, at + value.size)
            value[...] = values[span].reshape(value.shape)
            self.squares.setdefault(name, np.zeros(value.shape))[...] = squares[span].reshape(value.shape)
            at += value.size
        self.base = float(values[at])


def presence(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """For words and for beginnings, how many documents have each bucket and the sum of their labels."""
    flat = np.concatenate([*docs, np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    total = np.zeros((2, 2, BUCKETS))
    for k, buckets in enumerate((flat // BUCKETS, flat % BUCKETS)):
        pairs = np.unique(doc * BUCKETS + buckets)
        total[k] = np.bincount(pairs % BUCKETS, minlength=BUCKETS), np.bincount(pairs % BUCKETS, y[pairs // BUCKETS], BUCKETS)
    return total


def _evidence(present: np.ndarray, positive: np.ndarray, docs: int, labels: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the buckets with enough documents (0: none), and how many deviations each
    bucket's log-odds are from none."""
    negative = present - positive
    odds = np.log((positive + 0.5) / (labels + 1)) - np.log((negative + 0.5) / (docs - labels + 1))
    deviation = np.sqrt(1 / (positive + 0.5) + 1 / (negative + 0.5))
    known = present >= MIN_DOCS
    return np.where(known, np.cumsum(known), 0).astype(np.int32), (odds / deviation)[known]


def begin(found: np.ndarray, docs: int, labels: float) -> Net:
    """The network before the first step, from the ``presence`` in ``docs`` documents with ``labels`` labels."""
    rng = np.random.default_rng(SEED)
    table = []
    for k in range(2):
        row, z = _evidence(*found[k], docs, labels)
        vectors = np.zeros((len(z) + 1, DIMENSIONS))
        vectors[1:] = rng.standard_normal((len(z), DIMENSIONS)) * 0.05
        vectors[1:, k] = np.clip(z, -6, 6) / 3
        table.append((row, vectors))
    filters = [rng.standard_normal((w, DIMENSIONS, FILTERS)) * 0.1 / w for w in WIDTHS]
    for weight in filters:
        weight[0, 0, 0] += 1  # one filter of each width starts from the word's evidence,
        weight[0, 1, 1] += 1  # one from that of its beginning
    n = len(WIDTHS) * FILTERS
    net = Net(table[0][0], table[1][0], table[0][1], table[1][1], filters, np.full(n, -0.5), rng.standard_normal(n) * 0.1, 0.0)
    net.out[:: FILTERS] += 0.5
    net.out[1 :: FILTERS] += 0.5
    mean = min(max(labels / docs, 1e-3), 1 - 1e-3)
    net.base = float(np.log(mean / (1 - mean)))
    net.heavier = min(5.0, (1 - mean) / mean)
    return net


def rounds_of(docs: int) -> int:
    """A small table is seen more often."""
    return max(EPOCHS, -(-200 * BATCH // docs))


def train(docs: list[np.ndarray], y: np.ndarray) -> Net:
    net = begin(presence(docs, y), len(docs), float(y.sum()))
    net.learn(docs, y, rounds_of(len(docs)), np.random.default_rng(SEED))
    return net


def threshold(score: np.ndarray, positive: np.ndarray, count: np.ndarray | None = None) -> float:
    """Between the two scores where the F1 of what lies above is largest; the widest such gap.

    A score stands for ``count`` documents, of which ``positive`` have the label; for one if not given.
    """
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum(positive[order])
    above = np.cumsum(np.ones(len(s)) if count is None else count[order])
    f1 = 2 * hits / (above + hits[-1])
    gap = s - np.append(s[1:], min(0.0, s[-1]))
    f1[:-1][gap[:-1] <= 0] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = best[np.argmax(gap[best])]
    return float(s[at] - gap[at] / 2)


@dataclass
class Model:
    net: Net | None
    mean: float
    languages: language.Languages
    thresholds: np.ndarray  # per language, the last one for all others
    hasher: Hasher = field(default_factory=Hasher)

    def raw(self, docs: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.net.logits(docs), -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.mean)
        p = self.raw([self.hasher(t) for t in texts])
        t = self.thresholds[[self.languages.likeliest(x) for x in texts]]
        return np.clip(np.where(p < t, 0.5 * p / t, 0.5 + 0.5 * (p - t) / (1 - t)), 0, 1)


def _hashed(languages: language.Languages, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each document its shard, a hash to order it by, whether it is held back, and its words' buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, texts in slices(batches, "text", RUN_BYTES):
            ids = [x.encode() for x in batch.column("_id").cast(pa.string()).to_pylist()]
            codes = [hasher(t).tobytes() for t in texts]
            turn = np.array([xxhash.xxh64_intdigest(c, xxhash.xxh64_intdigest(x)) for x, c in zip(ids, codes)], np.uint64)
            held = [xxhash.xxh64_intdigest(x, SEED) % HELD_BACK == 0 for x in ids]
            guess = [languages.likeliest(t) if h else None for t, h in zip(texts, held)]
            columns = {"shard": pa.array((turn % shards).astype(np.int32)), "turn": pa.array(turn.view(np.int64)), "held": pa.array(held), "y": batch.column("_y"), "guess": pa.array(guess, pa.int32()), "codes": pa.array(codes, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _words(codes: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(c, np.int64) for c in codes]


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 2, BUCKETS))
    for batch, codes in slices(batches, "codes", RUN_BYTES):
        total += presence(_words(codes), np.asarray(batch.column("y")))
    for k in range(2):
        at = np.flatnonzero(total[k, 0])
        yield pa.RecordBatch.from_arrays([pa.array((at + k * BUCKETS).astype(np.int32)), pa.array(total[k, 0, at]), pa.array(total[k, 1, at])], names=["bucket", "present", "positive"])


_CHANGES = ["key", "n", *(f"v{k}" for k in range(2 * DIMENSIONS))]


def _round(net: Net, rounds: int, number: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What each shard makes of ``net`` in ``rounds`` rounds.

    A shard is held as a whole unless it is far larger than others; then by runs of its documents.
    """

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        docs, y, size, at = [], [], 0, None
        for batch, codes in slices(batches, "codes", RUN_BYTES):
            for shard, label, words in zip(batch.column("shard").to_pylist(), batch.column("y").to_pylist(), _words(codes)):
                if docs and (shard != at or len(docs) >= 2 * SHARD_ROWS or size >= 4 * SHARD_BYTES):
                    yield at, docs, np.array(y)
                    docs, y, size = [], [], 0
                docs.append(words)
                y.append(label)
                size, at = size + words.nbytes, shard
        if docs:
            yield at, docs, np.array(y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in itertools.groupby(held(batches), key=lambda part: part[0]):
            own, n, rng = copy.deepcopy(net), 0, np.random.default_rng([SEED, number, shard])
            for _, docs, y in parts:
                own.learn(docs, y, rounds, rng)
                n += len(docs)
            keys, weights, rows = own.changes(n)
            whole = np.rint(rows / UNIT).astype(np.int64) * weights[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(weights.astype(np.int64)), *map(pa.array, np.ascontiguousarray(whole.T))], names=_CHANGES)

    return run


def _trained(rows: DataFrame, net: Net, docs: int, shards: int) -> Net:
    """``net`` after all rounds; what comes to the driver of a round is at most a row per embedding."""
    every = rounds_of(docs)
    for number in range(1 if shards == 1 else every):
        moved = rows.mapInArrow(_round(net, every if shards == 1 else 1, number), ", ".join(["key int", *(f"{c} long" for c in _CHANGES[1:])]))
        table = moved.groupBy("key").agg(*(F.sum(c).alias(c) for c in _CHANGES[1:])).toArrow()
        n = np.asarray(table.column("n"), np.float64)
        sums = np.column_stack([np.asarray(table.column(c)) for c in _CHANGES[2:]])
        net.put(np.asarray(table.column("key")), sums / n[:, None] * UNIT)
    return net


def _levels(net: Net) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, codes in slices(batches, "codes", RUN_BYTES):
            level = np.rint(np.clip(net.logits(_words(codes)), -30, 30) * LEVELS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("guess"), pa.array(level), batch.column("y")], names=["guess", "level", "y"])

    return run


def _thresholds(model: Model, held: DataFrame) -> None:
    """A threshold for all, and for each language with enough held-back documents of both kinds.

    What comes to the driver is at most a row per language and step of the score.
    """
    scored = held.mapInArrow(_levels(model.net), "guess int, level int, y double").groupBy("guess", "level")
    table = scored.agg(F.count("*").alias("n"), F.count_if(F.col("y") > 0.5).alias("positive")).toArrow()
    guess, level, n, positive = (np.asarray(table.column(c), np.int64) for c in ("guess", "level", "n", "positive"))
    for k in [-1, *range(len(model.languages.names))]:
        own = guess == k if k >= 0 else np.ones(len(guess), bool)
        levels, at = np.unique(level[own], return_inverse=True)
        hits, every = np.bincount(at, positive[own]), np.bincount(at, n[own])
        if hits.sum() < 5 or (every - hits).sum() < 5:
            continue
        best = min(max(threshold(1 / (1 + np.exp(-levels / LEVELS)), hits, every), 1e-6), 1 - 1e-6)
        if k < 0:
            model.thresholds[:] = best
        else:
            share = hits.sum() / (hits.sum() + COMMON)
            odds = share * np.log(best / (1 - best)) + (1 - share) * np.log(model.thresholds[-1] / (1 - model.thresholds[-1]))
            model.thresholds[k] = 1 / (1 + np.exp(-odds))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", lang: str = "lang", shard_rows: int = SHARD_ROWS) -> Model:
    """Learn from all labels whose row satisfies ``usable``, a condition on the label table."""
    spark = docs.sparkSession
    means = labels.where(usable & F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.avg(F.col(label).cast("double")).alias("_y"))
    known, known_path = spill(means)
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(lang).alias("lang"))
    chosen, chosen_path = spill(join_measured(texts, known, "_id"))
    n, size = chosen.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    shards = max(1, math.ceil(n / shard_rows), math.ceil(size / SHARD_BYTES))
    languages = language.fit(chosen, F.lit(True))
    coded = chosen.mapInArrow(_hashed(languages, shards), "shard int, turn long, held boolean, y double, guess int, codes binary")
    rows, rows_path = spill(coded.repartition(shards, "shard").sortWithinPartitions("shard", "turn"))
    discard(spark, known_path, chosen_path)
    own = rows.where("not held").select("shard", "y", "codes")
    counted = rows.groupBy("held").agg(F.count("*").alias("n"), F.sum("y").alias("labels"), F.count_if(F.col("y") > 0.5).alias("positive")).collect()
    mean = sum(r.labels for r in counted) / n if n else 0.0
    learned = [r for r in counted if not r.held]
    model = Model(None, mean, languages, np.full(len(languages.names) + 1, 0.5))
    if learned and 0 < learned[0].positive < learned[0].n:
        # At most a row per bucket.
        found = own.mapInArrow(_present, "bucket int, present double, positive double").groupBy("bucket").agg(F.sum("present").alias("present"), F.sum("positive").alias("positive")).toArrow()
        total = np.zeros((2, 2 * BUCKETS))
        total[:, np.asarray(found.column("bucket"))] = np.asarray(found.column("present")), np.asarray(found.column("positive"))
        net = begin(total.reshape(2, 2, BUCKETS).swapaxes(0, 1), learned[0].n, learned[0].labels)
        model.net = _trained(own, net, learned[0].n, shards)
        model.net.squares, model.net.moved = {}, {}
        _thresholds(model, rows.where("held").select("guess", "y", "codes"))
    discard(spark, rows_path)
    return model
