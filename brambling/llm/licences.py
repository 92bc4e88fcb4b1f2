"""License scans with a positional index of rare words.

A notice is known by key phrases, which must stand word for word, and by its whole wording. A file is
the sequence of its words: runs of letters, digits and characters beyond ASCII, A-Z lowered.

1. Each task counts in how many documents a word of the notices occurs; the sums, one per such word,
   give its inverse document frequency over all documents.
2. The index has, for each key phrase, its words of the highest inverse frequency with their positions
   in it, rarest first. A file's words are looked up there. Each occurrence of the rarest word names
   the place where the phrase would begin; the occurrences of the next words must name the same place.
3. Where all agree, the key phrase is verified word by word. A notice is found where its first key
   phrase stands and each other one stands within ``SLACK`` words of its distance in the notice.
4. The share of a find is that part of the notice's words, weighted by inverse frequency, that stand
   at their positions relative to the first key phrase. A base phrase is found as a whole, so it has 1.

Any occurrence of a phrase has its rarest word, so none is missed whatever the frequencies are.

A null or empty text has no words and no finds. Finds may overlap; each is one, so a notice that
stands twice is found twice. Repeated rows give equal results. An empty table gives no rows. Columns
other than the two named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brambling.llm.common import slices
from brambling.llm.packed_words import LETTERS_DIGITS, TWO, pack_two, words_in

RARE = 3
SLACK = 8
RUN_BYTES = 1 << 20
DIGITS = 9
#: Finds whose whole notices are compared at once.
CHUNK = 1 << 12

# The base phrases and their labels.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
# Label, wording and key phrases of public notices and of the lines that name a license.
# The wordings have no other signs than blanks, as words are parted there.
NOTICES = (
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software"
        " to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"
        " and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction including without limitation"),
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("except in compliance with the license", "www apache org licenses license 2 0"),
    ),
    ("gpl-2.0", "gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation",
        ("you can redistribute it and or modify it under the terms of the gnu general public license",),
    ),
    ("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "gnu affero general public license", ("gnu affero general public license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
)


@dataclass
class Notice:
    label: str
    words: list[str]
    keys: list[list[str]]
    base: bool
    #: Where each key phrase begins in the notice.
    at: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.at = []
        for key in self.keys:
            places = [i for i in range(len(self.words)) if self.words[i : i + len(key)] == key]
            if not places:
                raise ValueError(f"{' '.join(key)} is not in the notice {self.label}")
            self.at.append(places[0])


def notices(base: tuple[tuple[str, str], ...] = BASE, others: tuple[tuple[str, str, tuple[str, ...]], ...] = NOTICES) -> list[Notice]:
    whole = [Notice(label, phrase.split(), [phrase.split()], True) for label, phrase in base]
    return whole + [Notice(label, wording.split(), [k.split() for k in keys], False) for label, wording, keys in others]


class Vocabulary:
    """The words of the notices; a word's number is its place in order."""

    def __init__(self, known: list[Notice]):
        self.words = sorted({w for n in known for w in n.words})
        raw = [w.encode() for w in self.words]
        if any(len(w) > TWO for w in raw):
            raise ValueError(f"a word of a notice has more than {TWO} bytes")
        self.number = {w: k for k, w in enumerate(self.words)}
        # Bytewise order is the order of the packed pairs.
        order = np.argsort(np.array([w.ljust(TWO, b"\0") for w in raw], f"S{TWO}"), kind="stable")
        high, low = (np.array([int.from_bytes(raw[k].ljust(TWO, b"\0")[a : a + 8]) for k in order], np.uint64) for a in (0, 8))
        self.high, first = np.unique(high, return_index=True)
        self.low, self.order, self.first, self.last = low, order, first, np.append(first[1:], len(low))

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(number, text)`` of each word of the texts; -1 for words that no notice has."""
        buffer, start, length, text = words_in(texts, LETTERS_DIGITS)
        number = np.full(len(start), -1, np.int64)
        short = np.flatnonzero(length <= TWO)
        high, low = pack_two(buffer, start[short], length[short])
        at = np.minimum(np.searchsorted(self.high, high), len(self.high) - 1)
        hit = np.flatnonzero(self.high[at] == high)
        # Few words share their first eight bytes.
        place, low, at = self.first[at[hit]], low[hit], at[hit]
        for _ in range(int((self.last - self.first).max())):
            more = (place < self.last[at] - 1) & (self.low[place] < low)
            place = place + more
        same = self.low[place] == low
        number[short[hit[same]]] = self.order[place[same]]
        return number, text


def _occurrences(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary.words)
        docs, total = np.zeros(size, np.int64), 0
        for _, texts in slices(batches, "text", RUN_BYTES):
            number, text = vocabulary.numbers(texts)
            known = number >= 0
            docs += np.bincount(np.unique(text[known] * size + number[known]) % size, minlength=size)
            total += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size)), pa.array(np.append(total, docs))], names=["word", "docs"])

    return count


def inverse_frequencies(rows: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """log((documents + 1) / (documents with the word + 1)) + 1 per word of the notices."""
    sums = rows.select("text").mapInArrow(_occurrences(vocabulary), "word long, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    # One row per word of the notices, and one for the number of documents.
    found = {r.word: r.docs for r in sums.collect()}
    total = found.get(-1, 0)
    return np.array([math.log((total + 1) / (found.get(k, 0) + 1)) + 1 for k in range(len(vocabulary.words))])


def rarest(phrase: np.ndarray, weight: np.ndarray, most: int = RARE) -> np.ndarray:
    """Positions of the phrase's words of the highest weight; of equal ones the first."""
    return np.argsort(-weight[phrase], kind="stable")[:most]


class Scanner:
    """Finds of all notices in runs of texts."""

    def __init__(self, known: list[Notice], vocabulary: Vocabulary, weight: np.ndarray):
        self.known, self.vocabulary, self.weight = known, vocabulary, weight
        of = lambda words: np.array([vocabulary.number[w] for w in words])
        self.whole = [of(n.words) for n in known]
        self.keys = [[of(k) for k in n.keys] for n in known]
        # The index: the rare words of a phrase and their positions in it.
        self.index = {tuple(k): rarest(k, weight) for keys in self.keys for k in keys}

    def places(self, phrase: np.ndarray, number: np.ndarray, text: np.ndarray, postings: Callable[[int], np.ndarray]) -> np.ndarray:
        """Where the phrase stands, in order."""
        rare = self.index[tuple(phrase)]
        begins = postings(phrase[rare[0]]) - rare[0]
        begins = begins[(begins >= 0) & (begins + len(phrase) <= len(number))]
        for position in rare[1:]:
            begins = begins[number[begins + position] == phrase[position]]
        begins = begins[text[begins] == text[begins + len(phrase) - 1]]
        for position in range(len(phrase)):
            begins = begins[number[begins + position] == phrase[position]]
        return begins

    def shares(self, whole: np.ndarray, begins: np.ndarray, first: np.ndarray, number: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Of notices that would begin at ``begins``, the weighted part of the words that stand there."""
        out, weight = np.zeros(len(begins)), self.weight[whole]
        for a in range(0, len(begins), CHUNK):
            at = begins[a : a + CHUNK, None] + np.arange(len(whole))
            held = np.clip(at, 0, len(number) - 1)
            same = (at == held) & (number[held] == whole) & (text[held] == text[first[a : a + CHUNK], None])
            out[a : a + CHUNK] = np.where(same, weight, 0.0).sum(axis=1) / weight.sum()
        return np.round(out, DIGITS)

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(words of each text, text, start, notice, share)`` of the finds, by text, start and notice."""
        number, text = self.vocabulary.numbers(texts)
        words = np.bincount(text, minlength=len(texts))
        ends_at = np.cumsum(words) - 1
        first = ends_at - words + 1
        hits = np.flatnonzero(number >= 0)
        hits = hits[np.argsort(number[hits], kind="stable")]
        ends = np.cumsum(np.bincount(number[hits], minlength=len(self.weight)))
        postings = lambda word: hits[ends[word - 1] if word else 0 : ends[word]]
        found = []
        for k, notice in enumerate(self.known):
            begins = self.places(self.keys[k][0], number, text, postings)
            for key, at in list(zip(self.keys[k], notice.at))[1:]:
                others, wanted = self.places(key, number, text, postings), begins + at - notice.at[0]
                low, high = np.maximum(wanted - SLACK, first[text[begins]]), np.minimum(wanted + SLACK, ends_at[text[begins]])
                begins = begins[np.searchsorted(others, high, side="right") > np.searchsorted(others, low)]
            if len(begins):
                share = np.ones(len(begins)) if notice.base else self.shares(self.whole[k], begins - notice.at[0], begins, number, text)
                found.append((begins, np.full(len(begins), k), share))
        if not found:
            none = np.zeros(0, np.int64)
            return words, none, none, none, np.zeros(0)
        start, notice, share = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((notice, start))
        start, notice, share = start[order], notice[order], share[order]
        return words, text[start], start - first[text[start]], notice, share


_FOUND = "array<struct<start:long,length:int,label:string,base:boolean,share:double>>"


def _finder(scanner: Scanner) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    labels = pa.array([n.label for n in scanner.known])
    lengths = np.array([len(n.keys[0]) for n in scanner.known], np.int32)
    base = np.array([n.base for n in scanner.known])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", RUN_BYTES):
            words, text, start, notice, share = scanner.scan(texts)
            columns = [pa.array(start), pa.array(lengths[notice]), labels.take(pa.array(notice)), pa.array(base[notice]), pa.array(share)]
            rows = pa.StructArray.from_arrays(columns, names=["start", "length", "label", "base", "share"])
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), lists], names=["doc_id", "n_words", "found"])

    return find


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: list[Notice] | None = None) -> DataFrame:
    """``(doc_id, n_words, found)``: what was found where, ``start`` in words, ``length`` that of the first key phrase."""
    known = known or notices()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    vocabulary = Vocabulary(known)
    scanner = Scanner(known, vocabulary, inverse_frequencies(rows, vocabulary))
    shape = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("found", T._parse_datatype_string(_FOUND))])
    return rows.mapInArrow(_finder(scanner), shape)


def digest(found: DataFrame) -> DataFrame:
    """Counts, first and last place of the base phrases, and labels."""
    base, start = F.filter("found", lambda x: x["base"]), lambda x: x["start"]
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda x: x["label"]))), ",")
    score: Column = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(F.transform(base, start)).alias("first_word"),
        F.array_max(F.transform(base, start)).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("found")).alias("labels"), score.alias("score"),
    )
