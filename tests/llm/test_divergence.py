from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from brambling.llm import divergence as dv
from brambling.llm import packed_words as pw

SCHEMA = "doc_id long, text string, lang string, source string, term string, count long, slot int"


def brute(rows, least, top):
    docs, counts = defaultdict(set), defaultdict(Counter)
    groups = set()
    for k, (_, text, lang, source, *_) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low):
            docs[lang, term].add(k)
            counts[lang, source][term] += 1
    out = []
    for lang, source in groups:
        kept = [t for (x, t), d in docs.items() if x == lang and len(d) >= least]
        others = [s for x, s in groups if x == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in others}
        q = shares(sum((counts[lang, s] for s in others), Counter()))
        mine = p[source]
        pairs = [(s, sum(abs(mine[t] - p[s][t]) for t in kept)) for s in others if s != source]
        terms = [(t, mine[t] - q[t]) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def planted(seed=3, n=300):
    rng = random.Random(seed)
    words = ["a", "B", "eight888", "eightabc", "ninechars", "sixteencharacter", "seventeenletters", "ß", "日本語の文", "naïve", "x" * 40, "x" * 41, "é" * 3000, "Ａ", "á"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["hot"] * 5 + ["s1", "s2", None, "é", "zero"])
        k = rng.choice([0, 1, 5, 40])
        text = " ".join(rng.choice(words[: rng.choice([4, len(words)])]) + rng.choice(["", "!", "7", "\x7f"]) for _ in range(k))
        rows.append((i // 2, None if rng.random() < 0.05 else text, lang, source, "t", 1, 2))
    rows += [(0, "once only", "fr", "one", "", 0, 0), (0, None, "fr", None, "", 0, 0), (1, "", "it", "s", "", 0, 0)]
    return rows


def tuples(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("side", [256, 2])
def test_against_brute_force(spark, monkeypatch, side):
    monkeypatch.setattr(dv, "TILE_SOURCES", side)
    monkeypatch.setattr(dv, "TILE_TERMS", 4)
    monkeypatch.setattr(dv, "RUN_BYTES", 5000)
    monkeypatch.setattr(dv, "HELD", 60)
    rows = planted()
    got = dv.audit(spark.createDataFrame(rows, SCHEMA).repartition(5), least=8, top=3)
    want = brute(rows, 8, 3)
    assert tuples(got) == want and {w[2] for w in want} == {"pair", "term"}
    assert any(len(w[3].encode()) > 16 for w in want if w[2] == "term") and any(w[4] == 0 for w in want)


def test_ties_and_absent_terms(spark):
    rows = [(i, t, "en", s, "", 0, 0) for i, (t, s) in enumerate([("b a c", "x"), ("é z", "y"), ("", "w"), (None, "v")])]
    got = dv.audit(spark.createDataFrame(rows, SCHEMA), least=1)
    assert tuples(got) == brute(rows, 1, 50)


def test_empty_table(spark):
    assert dv.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_share_is_exact(spark):
    rows = [(c, n, v) for c, n, v in [(0, 0, 1), (10**14, 10**15, 10**8), (999_999_999, 3 * 10**9 + 7, 11), (5, 10**13, 3)]]
    df = spark.createDataFrame(rows, "count long, n long, terms long").select("count", "n", "terms", dv.share("count", "n").alias("p"))
    assert all(r.p == 1 + 10**9 * (r["count"] + 5) // (r.n + 5 * r.terms) for r in df.collect())


def test_radix_order():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 4000).astype(np.uint64) << np.uint64(40), rng.integers(0, 2**63, 4000).astype(np.uint64)
    assert (pw.radix_order(a, b) == np.lexsort((b, a))).all()
    assert (pw.radix_order(a) == np.argsort(a, kind="stable")).all() and len(pw.radix_order(a[:0])) == 0


def test_words_in_parts_texts():
    texts = ["Ab cd".encode(), b"", "éÉ9".encode(), b"z" * 20, b"\xff\x00a"]
    buffer, start, length, text = pw.words_in(texts, pw.LETTERS)
    found = [(int(t), bytes(buffer[s : s + n])) for s, n, t in zip(start, length, text)]
    assert found == [(0, b"ab"), (0, b"cd"), (2, "éÉ".encode()), (3, b"z" * 20), (4, b"\xff"), (4, b"a")]
    hi, lo = pw.pack_two(buffer, start, length)
    assert [int(x).to_bytes(8) + int(y).to_bytes(8) for x, y in zip(hi, lo)] == [w[:16].ljust(16, b"\0") for _, w in found]
