from __future__ import annotations

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from brambling.llm import secrets

KINDS = ("assign", "access", "hex")


def brute_base(text):
    text, out = text or "", []
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    out += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def brute_entropy(text):
    """All windows afresh, without incremental counts."""
    text, out = text or "", []
    base = brute_base(text)
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        if re.search(secrets.ALLOWED.replace("(?i:", "(?i:"), m[0]):
            continue
        bits = next(t for p, t in secrets.CLASSES if re.search(p, m[0]))
        hot = []
        for i in range(len(m[0]) - secrets.WINDOW + 1):
            window = m[0][i : i + secrets.WINDOW]
            entropy = -sum(window.count(c) / 20 * math.log2(window.count(c) / 20) for c in set(window))
            if entropy >= bits - 1e-12:
                hot.append(i)
        if hot:
            a, b = m.start() + hot[0], m.start() + hot[-1] + secrets.WINDOW
            if not any(x <= a and b <= y for x, _, y in base):
                out.append((a, 3, b))
    return out


def texts():
    rng = random.Random(5)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    blob = lambda n, cs=chars: "".join(rng.choice(cs) for _ in range(n))
    out = [None, "", "é" * 5 + " password = 'hunter22' ", "token=token: secret99", "TOKEN:abc token=abcdef", "token=api_key=abcdefgh", "paſſword=abcdefg"]
    out += ["AKIA" + "A" * 15, "AKIAAKIA" + "B" * 16, "0123456789abcdef01234567", "0123456789abcdef0123456", "g" + "a" * 24 + "h" + "f" * 30]
    out += [f"x {blob(40)} y 😀 {blob(32)}" for _ in range(5)] + [f"{blob(30, 'ABCDEF0123456789')} api-key passwd: {blob(20)}"]
    out += ["123e4567-e89b-12d3-a456-426614174000 is a uuid", "a" * 500, "word-with-many-dashes-and-7", blob(3000), ("secret: " + blob(12) + " ") * 200]
    out += [blob(400, "ab01= :token" ) for _ in range(10)]
    return out


def test_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = {r.doc_id: r for r in secrets.digest(secrets.scan(df)).collect()}
    for i, text, _ in rows:
        base = brute_base(text)
        every = sorted(base + brute_entropy(text))
        name = lambda spans: ",".join(f"{(*KINDS, 'entropy')[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i].spans == name(every), text
        assert got[i].base_sha256 == hashlib.sha256(name(base).encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
    assert any("entropy" in r.spans for r in got.values())


def test_empty_table_and_repeated_rows(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = spark.createDataFrame([(None, "token=abcdef")] * 2, "doc_id long, text string")
    assert [r.spans for r in secrets.digest(secrets.scan(twice)).collect()] == ["assign:0:12"] * 2


def test_allowed_words_inside_random_strings(spark):
    rng = random.Random(8)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+"
    blob = lambda n: "".join(rng.choice(chars) for _ in range(n))
    a, b = blob(24), blob(24)
    found = {f"x {a}//{b}": "entropy:2:52", f"//{a}{b}": "entropy:0:50"}
    found |= {f"{mark}{a}": f"entropy:{len(mark)}:{len(mark) + 24}" for mark in ("Sample", "xxxxxx", "my-EXAMPLE", "abcdefgh")}
    found |= {f"x {a}dummy{b}": "entropy:2:55", f"{a[:18]}example{b[:18]}": "", f"https://{a}{b}": "", f"see {a[:14]}Placeholder{b[:14]}": ""}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(found)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.digest(secrets.scan(df)).collect()}
    assert [got[i] for i in range(len(found))] == list(found.values())


def test_long_texts(spark):
    """Shapes that a recursive match or a list grown by copies would not get through."""
    rng = random.Random(2)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    blob = lambda n: "".join(rng.choice(chars) for _ in range(n))
    many = "".join(f"token={blob(12)} " for _ in range(20_000))
    both = "".join(f"token={blob(30)} " for _ in range(3000))
    found = {"-".join(["ab"] * 350_000) + "-7": "", "/".join(["docs"] * 200_000) + "/v2": "", "0123456789" * 100_000: "hex:0:1000000", "a" * 1_000_000: "hex:0:1000000"}
    found |= {"0123456789abcdef" * 60_000 + "é": "hex:0:960000", "A" * 500_000 + "7" * 500_000: "hex:500000:1000000", "x" * 1_000_000 + "=1": "", blob(200_000): "entropy:0:200000"}
    found |= {many: ",".join(f"assign:{19 * k}:{19 * k + 18}" for k in range(20_000)), both: ",".join(f"assign:{37 * k}:{37 * k + 36}" for k in range(3000))}
    rows = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.spans for r in secrets.digest(secrets.scan(rows)).collect()}
    assert [got[k][:40] for k in range(len(found))] == [s[:40] for s in found.values()]
    assert [got[k] for k in range(len(found))] == list(found.values())


def test_running_sums(spark):
    rows = [([rng.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 10, 50, 101) for rng in [random.Random(n)]]
    df = spark.createDataFrame(rows, "x array<bigint>")
    most = secrets.running(F.col("x"), lambda a, b: F.greatest(a, b))
    for r in df.select("x", secrets.running(F.col("x")).alias("sums"), most.alias("most")).collect():
        assert r.sums == [sum(r.x[: k + 1]) for k in range(len(r.x))] and r.most == [max(r.x[: k + 1]) for k in range(len(r.x))]


def test_allowed_shapes_are_the_same(spark):
    """Possessive groups accept what the plain ones do."""
    plain = re.compile(secrets.ALLOWED.replace("?+", "?").replace("++", "+").replace("*+", "*"))
    rng = random.Random(6)
    parts = ["0123456789", "abcdef", "ABCDEF", "ab", "-", "_", "/", "7", "0123456", "01234567890123456789", "x9", "Q"]
    samples = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(3000)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = {r.s: r.ok for r in df.select("s", F.col("s").rlike(secrets.ALLOWED).alias("ok")).collect()}
    assert all(got[s] == bool(plain.search(s)) for s in samples) and len(set(got.values())) == 2
