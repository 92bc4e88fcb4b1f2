from __future__ import annotations

import hashlib
import random

from brambling.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, sha1 string"


def brute(rows):
    data = [(i, (h or "").encode()) for i, _, h, *_ in rows]
    last = {}
    for i, p in data:
        if len(p) >= 1000:
            last[p] = max(last.get(p, -1), -1 if i is None else i)
    out = []
    for i, p in data:
        to = last.get(p)
        refers = None if to is None or to == -1 or to == i else to
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def pages():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abc é<p>\r\n\0世") for _ in range(n))
    rows = [(i, f"http://x/{i}?a b\r\nWARC-Type: y", f"<html><head>{i}</head>" + text(rng.randrange(3000)), "p", "s") for i in range(200)]
    big, short, long = text(1500), "s" * 999, "b" * 400_000
    rows += [(1000 + i, None, big, None, None) for i in range(70)] + [(2000 + i, "u", short, "p", "s") for i in range(3)]
    rows += [(2500 + i, "u", "t" * 1000, "p", "s") for i in range(2)]
    rows += [(3000, "u", None, "p", "s"), (3001, "u", "", "p", "s"), (None, "u", big, "p", "s"), (None, "u", "n" * 2000, "p", "s"), (None, "u", "n" * 2000, "p", "s")]
    rows += [(4000, "u", long, "p", "s"), (4001, "u", long, "p", "s"), (5000, "u", "d" * 1200, "p", "s"), (5000, "u", "d" * 1200, "p", "s")]
    return rows


def round_trip(spark, df, path):
    warc.write_warc(df, path)
    return sorted((tuple(r) for r in warc.read_warc(spark, path).collect()), key=str)


def test_round_trip(spark, tmp_path):
    assert round_trip(spark, spark.createDataFrame(pages(), SCHEMA), str(tmp_path / "w")) == brute(pages())


def test_files_lead_with_the_dictionary(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame(pages(), SCHEMA).coalesce(2), path)
    files = [bytes(r.content) for r in warc.read_bytes(spark, path).collect()]
    assert files and all(int.from_bytes(f[:4], "little") == warc.DICTIONARY_MAGIC for f in files)
    records = [x for f in files for x in warc.records_of(memoryview(f))]
    assert len(records) == len(pages())
    assert all("\n" not in r["warc-target-uri"] for r, *_ in records if "warc-target-uri" in r)


def test_few_and_no_rows(spark, tmp_path):
    one = [(1, "u", "x", "p", "s")]
    assert round_trip(spark, spark.createDataFrame(one, SCHEMA), str(tmp_path / "one")) == brute(one)
    assert round_trip(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "none")) == []


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "DICTIONARY_BYTES", 2_000)
    rng = random.Random(4)
    noise = lambda n: "".join(chr(rng.randrange(32, 127)) for _ in range(n))
    rows = [(i, "u", noise(rng.randrange(3000)), "p", "s") for i in range(150)] + [(500, "u", noise(60_000), "p", "s"), (501, "u", noise(300), "p", "s")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    path = str(tmp_path / "w")
    assert round_trip(spark, df, path) == brute(rows)
    sizes = sorted(len(r.content) for r in warc.read_bytes(spark, path).collect())
    assert len(sizes) > 5 and sizes[-2] < 20_000 + 2_000 + 8 * (warc.FILE_ROWS + 2)


def test_many_copies_meet_in_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    assert round_trip(spark, spark.createDataFrame(pages(), SCHEMA), str(tmp_path / "w")) == brute(pages())
