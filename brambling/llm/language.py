"""Language identification as inference of a mixture.

A language is a distribution over hashed letter trigrams, counted over all training documents. A
document is taken as a mixture of languages: expectation-maximisation estimates their proportions
from the likelihoods of its trigrams, over all languages. The set of languages is the one among the
most likely first one, two, ... whose likelihood less a penalty per language is largest; sizes that
cannot reach the best so far, whatever their proportions, are left out. The prediction is the largest
part of the mixture over that set, its proportion in it among all languages is the score.

A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing could
be learned. A null language is not learned from. Equal proportions go to the language that comes
first by name. Repeated rows get equal results; an empty table gives an empty one. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.llm.common import fold, slices

UNKNOWN = "und"
BUCKETS = 1 << 15
ROUNDS = 12
PRIOR = 2.0
SMOOTHING = 0.5
# Cost of one more language, in units of the logarithm of the number of trigrams; overlapping
# trigrams repeat evidence, so it is above the usual half.
PENALTY = 3.0
RUN_BYTES = 4 << 20

_LETTER = re.compile(r"[^\W\d_]")
_BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of the trigrams of a text's letters, other characters being blanks."""
    plain = b" ".join(text.decode("utf-8", "replace").lower().encode().translate(_BLANK).split())
    b = np.frombuffer(b" " + plain + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((grams * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass
class Languages:
    names: list[str]
    likelihood: np.ndarray  # bucket x language
    share: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, np.ndarray], docs: dict[str, int]) -> Languages:
        names = sorted(counts)
        total = np.array([counts[n] for n in names], np.float64).reshape(len(names), BUCKETS) + SMOOTHING
        share = np.array([docs[n] for n in names], np.float64)
        return cls(names, np.ascontiguousarray((total / total.sum(1, keepdims=True)).T), share / max(1.0, share.sum()))

    def _mixture(self, table: np.ndarray, weight: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, float]:
        part = prior / prior.sum()
        prior = part * PRIOR
        n = weight.sum() + PRIOR
        for _ in range(ROUNDS):
            part = (part * ((weight / (table @ part)) @ table) + prior) / n
        return part, float(weight @ np.log(table @ part))

    def predict(self, text: bytes) -> tuple[str, float, str]:
        """The language, its proportion, and the chosen set with proportions."""
        if not self.names or not _LETTER.search(text.decode("utf-8", "replace")):
            return UNKNOWN, 0.0, ""
        counts = np.bincount(trigrams(text), minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        weight, table = counts[seen].astype(np.float64), self.likelihood[seen]
        alone = weight @ np.log(table) + np.log(np.maximum(self.share, 1e-12))
        prior = np.maximum(self.share, 1e-6)
        every, _ = self._mixture(table, weight, prior)
        order = np.argsort(-every, kind="stable")
        cost = PENALTY * np.log(max(2.0, weight.sum()))
        # No mixture is likelier than if each trigram came from its likeliest language.
        most = float(weight @ np.log(table.max(1)))
        best, chosen, part = -np.inf, order[:1], np.ones(1)
        for size in range(1, len(order) + 1):
            if most - cost * size <= best:
                break
            members = order[:size]
            if size == 1:
                members = np.array([int(np.argmax(alone))])
                own, value = np.ones(1), float(weight @ np.log(table[:, members[0]]))
            else:
                own, value = self._mixture(np.ascontiguousarray(table[:, members]), weight, prior[members])
            if value - cost * size > best:
                best, chosen, part = value - cost * size, members, own
        at = int(np.argmax(part))
        names = [self.names[k] for k in chosen]
        listed = ",".join(f"{n}:{p:.3f}" for n, p in zip(names, part))
        return names[at], float(min(1.0, max(0.0, every[chosen[at]]))), listed

    def likeliest(self, text: bytes) -> int:
        """The place of the single likeliest language, -1 without any."""
        if not self.names:
            return -1
        grams = trigrams(text)
        counts = np.bincount(grams, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        return int(np.argmax(counts[seen] @ np.log(self.likelihood[seen]) + np.log(np.maximum(self.share, 1e-12))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch, texts in slices(batches, "text", RUN_BYTES):
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            own += np.bincount(trigrams(text), minlength=BUCKETS)
            docs[lang] = docs.get(lang, 0) + 1
    for lang, own in counts.items():
        seen = np.flatnonzero(own)
        arrays = [pa.array([lang] * (len(seen) + 1)), pa.array(np.append(seen, -1).astype(np.int32)), pa.array(np.append(own[seen], docs[lang]))]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])


def fit(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang") -> Languages:
    """Count the trigrams of every usable document with a language.

    Each task sums its own counts; what comes to the driver is at most ``BUCKETS`` numbers per
    language.
    """
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    seen: dict[str, int] = {}
    table = sums.toArrow().to_pydict()
    for name, bucket, n in zip(table["lang"], table["bucket"], table["n"]):
        own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
        if bucket < 0:
            seen[name] = n
        else:
            own[bucket] = n
    return Languages.of(counts, seen)


def _identify(model: Languages) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", RUN_BYTES):
            names, scores, sets = zip(*map(model.predict, texts))
            arrays = [batch.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(sets)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "languages"])

    return run


def identify(docs: DataFrame, model: Languages, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, languages)`` per row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_identify(model), "doc_id long, lang_pred string, score double, languages string")


def identify_held_out(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """Learn from all folds of ``docs`` but one and predict every row."""
    model = fit(docs, fold("doc_id", parts) != held)
    return identify(docs, model).withColumn("held_out", fold("doc_id", parts) == held)
