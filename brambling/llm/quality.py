"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document is described by statistics of its characters, words and lines. They are standardised and
mapped to random Fourier features, whose inner products approximate a Gaussian kernel. Every
partition of the training rows sums its normal equations, per fold; ridge scores come from the sums
of all folds but one, the rows of that fold are scored with them, and these scores are calibrated
against the labels by pooling adjacent violators. The model that scores documents is fitted to all
folds. Training rows are a sample of at most about ``TRAIN_ROWS`` labelled documents, chosen by a
hash of the id.

Labels of one id are averaged; null labels and ids do not count. A null text is empty; empty texts
have statistics and so a score like all others. Without any label every score is 0.5. Repeated rows
get equal scores. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brambling.llm.common import fresh, slices
from brambling.session import store

TRAIN_ROWS = 20_000
FEATURES = 256
FOLDS = 4
RIDGE = 1e-3
SEED = 11
PARTITIONS = 8
RUN_BYTES = 1 << 20
CLIP = 4.0

_GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?", b"#$%&*@^~`", b"|<>[]{}=\\/", b"\"'()-_")
_MEMBERS = np.zeros((256, len(_GROUPS)))
for _k, _group in enumerate(_GROUPS):
    _MEMBERS[list(_group), _k] = 1
STATISTICS = 20


def statistics(text: bytes) -> np.ndarray:
    """What the classifier sees of a text in UTF-8."""
    n = max(1, len(text))
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MEMBERS / n
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    again = sum(map(operator.eq, words, words[1:]))
    lines = text.split(b"\n")
    tails = Counter(x[-1] for x in words)
    plain = sum(v for c, v in tails.items() if c >= 128 or chr(c).isalnum())
    own = (
        np.log1p(len(text)), np.log1p(len(words)), lengths.mean(), lengths.std(), len(counts) / w, again / w,
        max(counts.values(), default=0) / w, np.log1p(len(words) / len(lines)), len(set(lines)) / len(lines), plain / w,
        sum(map(bytes.isupper, words)) / w,
    )
    return np.concatenate([shares, own])


@dataclass
class Kernel:
    """Standardisation and random Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, seed: int) -> Kernel:
        rng = np.random.default_rng(seed)
        # A Gaussian kernel whose width is the usual distance of two standardised rows.
        frequency = rng.standard_normal((len(mean), FEATURES)) / np.sqrt(len(mean))
        return cls(mean, scale, frequency, rng.uniform(0, 2 * np.pi, FEATURES))

    def features(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.cos(z @ self.frequency + self.phase) * np.sqrt(2 / FEATURES), np.ones((len(rows), 1))])


@dataclass
class Model:
    kernel: Kernel | None
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(texts), 0.5)
        raw = self.kernel.features(np.array([statistics(t) for t in texts])) @ self.weights
        return np.clip(np.interp(raw, *self.steps), 0.0, 1.0)


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing steps that fit labels to scores best: the blocks' mean scores and mean labels."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for x, y in zip(score[order], label[order]):
        blocks.append([x, y, 1.0])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    x, y, n = np.array(blocks).T
    return x / n, y / n


def label_sample(labels: DataFrame, doc_id: str, label: str, usable: Column, most: int) -> DataFrame:
    """``(_id, _y)``: at most about ``most`` usable ids with their mean label, chosen by a hash."""
    rows = labels.where(usable & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    n = rows.count()
    chosen = F.pmod(F.xxhash64(F.lit(SEED), F.col(doc_id).cast("string")), F.lit(1 << 30)) < min(1 << 30, (most << 30) // max(1, n))
    return rows.where(chosen).groupBy(F.col(doc_id).alias("_id")).agg(F.avg(F.col(label).cast("double")).alias("_y"))


def training_texts(docs: DataFrame, sample: DataFrame, doc_id: str, *columns: Column) -> DataFrame:
    """The sampled documents. The sample has a bounded number of rows and is broadcast."""
    rows = docs.select(F.col(doc_id).alias("_doc"), *columns)
    return rows.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).drop("_doc")


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text", RUN_BYTES):
        rows = [statistics(t).tolist() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("_y"), pa.array(rows, pa.list_(pa.float64()))], names=["fold", "y", "x"])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
    return np.asarray(batch.column("fold")), np.asarray(batch.column("y")), x


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((3, STATISTICS))
    for batch in batches:
        _, _, x = _arrays(batch)
        total += [np.full(STATISTICS, len(x)), x.sum(0), (x**2).sum(0)]
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _normal_equations(kernel: Kernel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            fold, y, x = _arrays(batch)
            z = kernel.features(x)
            for k in range(FOLDS):
                own = z[fold == k]
                total[k] += np.hstack([own.T @ own, (own.T @ y[fold == k])[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return sums


def _solve(total: np.ndarray) -> np.ndarray:
    left, right = total[:, :-1], total[:, -1]
    n = max(1.0, left[-1, -1])  # the constant feature counts the rows
    return np.linalg.solve(left + RIDGE * n / FEATURES * np.eye(len(left)), right)


def _oof(kernel: Kernel, weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, y, x = _arrays(batch)
            raw = (kernel.features(x) * weights[fold]).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(raw), pa.array(y)], names=["score", "y"])

    return score


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labels whose row satisfies ``usable``, a condition on the label table."""
    sample = label_sample(labels, doc_id, label, usable, train_rows)
    part = F.pmod(F.xxhash64(F.lit("fold"), F.col("_id")), F.lit(FOLDS)).cast("int").alias("fold")
    chosen = training_texts(docs, sample, doc_id, F.col(text).alias("text"))
    rows = store(chosen.select(part, "_y", "text").mapInArrow(_describe, "fold int, y double, x array<double>"))
    dealt = rows.coalesce(PARTITIONS)
    moments = sum((np.frombuffer(r.sums).reshape(3, -1) for r in dealt.mapInArrow(_moments, "sums binary").collect()), np.zeros((3, STATISTICS)))
    n = moments[0, 0]
    if not n:
        return Model(None, np.zeros(0), (np.zeros(1), np.zeros(1)))
    mean = moments[1] / n
    scale = np.sqrt(np.maximum(moments[2] / n - mean**2, 0))
    kernel = Kernel.draw(mean, np.where(scale > 1e-9, scale, 1.0), SEED)
    # At most PARTITIONS rows of fixed size.
    parts = dealt.mapInArrow(_normal_equations(kernel), "sums binary").collect()
    sums = np.sum([np.frombuffer(r.sums).reshape(FOLDS, FEATURES + 1, -1) for r in parts], axis=0)
    others = np.array([_solve(sums.sum(0) - sums[k]) for k in range(FOLDS)])
    scored = dealt.mapInArrow(_oof(kernel, others), "score double, y double").collect()  # bounded by the sample
    steps = isotonic(np.array([r.score for r in scored]), np.array([r.y for r in scored]))
    return Model(kernel, _solve(sums.sum(0)), steps)


def with_score(docs: DataFrame, model, keep: list[str], text: str, name: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the text's score by ``model.score`` as ``name``."""
    # A text that is kept goes to Python once.
    fields, texts_name = [docs.schema[c] for c in keep], text if text in keep else fresh("_text", keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, texts_name, RUN_BYTES):
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.score(texts), pa.float64())], names=[*keep, name])

    more = [] if text in keep else [F.col(f"`{text}`").alias(texts_name)]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *more)
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField(name, T.DoubleType())]))
