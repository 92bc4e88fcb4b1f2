from __future__ import annotations

import random
import re
import zlib
from pathlib import Path

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from brambling.llm import token_files as tf
from brambling.llm.queries import op7_token_id_output

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, part int, start string"


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    out, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def docs():
    rng = random.Random(1)
    chars = "abc dé#\n\t 1²ñ'’sﬀ世😀  !!"
    rows = [(i, "".join(rng.choice(chars) for _ in range(rng.randrange(400))), 1, "x") for i in rng.sample(range(-50, 1000), 150)]
    rows += [(2000, None, None, None), (2001, "", 0, None), (None, "no id", 0, "x"), (2002, "the cat's <|endoftext|> don't  \n\n x", 0, "x")]
    rows += [(2003, "b", 0, "x"), (2003, "a", 0, "x"), (2003, "b", 0, "x"), (2004, "long words " * 30_000, 0, "x"), (2005, "a" * 20_000, 0, "x")]
    return rows


def got(df, **options):
    return sorted((tuple(r) for r in tf.tokens_of(df, PATH, **options).collect()), key=lambda r: r[1])


def test_round_trip(spark):
    df = spark.createDataFrame(docs(), SCHEMA).repartition(3)
    assert got(df) == brute(docs())
    assert got(df, bits=True, pattern=None) == brute(docs())


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_chunks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 9, 5000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        for bits in (False, True):
            assert (tf.unpack_chunk(memoryview(tf.pack_chunk(ids, bits))) == ids).all()


def test_forgetting_pieces(monkeypatch):
    monkeypatch.setattr(tf, "PIECES", 6)
    monkeypatch.setattr(tf, "JOINED", 3)
    encoder = tf.Encoder(open(PATH, encoding="utf-8").read(), tf.PATTERN)
    whole = Tokenizer.from_file(PATH)
    for batch in (["a b c d e f b b"], ["g h i a b", ""], ["x", "y z wörter unbekanntes"], ["a b unbekanntes g  x"] * 2, [""], []):
        assert [x.tolist() for x in encoder.encode(batch)] == [whole.encode(t).ids for t in batch]
    assert " b" in encoder.place


def test_white_space_in_every_place():
    rng = random.Random(9)
    encoder = tf.Encoder(open(PATH, encoding="utf-8").read(), tf.PATTERN)
    whole = Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice(("a", "b's", " ", " ", "\n", ".", "7", "é", "\t", "x y")) for _ in range(rng.randrange(14))) for _ in range(4000)]
    assert [x.tolist() for x in encoder.encode(texts)] == [whole.encode(t).ids for t in texts]


def test_every_plain_character():
    encoder = tf.Encoder(open(PATH, encoding="utf-8").read(), tf.PATTERN)
    whole = Tokenizer.from_file(PATH)
    plain = [chr(c) for c in range(0x3000) if tf.PLAIN.fullmatch(chr(c))]
    assert len(plain) > 700
    texts = [f"ab{c}d {c}e 1{c}2 {c}{c} .{c}! '{c} {c} \n{c}\n  {c}s't" for c in plain]
    assert [x.tolist() for x in encoder.encode(texts)] == [whole.encode(t).ids for t in texts]


def test_special_tokens_as_the_library_does(spark, tmp_path):
    texts = ["the cat's <|endoftext|> don't  \n\n x", "a<|endoftext|><|endoftext|>b", " <|endoftext| > é", "世 <|endoftext|>", "the cat's"]
    untouched, start, want = Tokenizer.from_file(PATH), 0, []
    for k, text in enumerate(texts):
        ids = untouched.encode(text, add_special_tokens=False).ids + [2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert 50256 in untouched.encode(texts[0], add_special_tokens=False).ids
    for rows in (op7_token_id_output(spark, str(tmp_path)), pipeline.encoded(spark, df, "")):
        assert sorted((tuple(r) for r in rows.collect()), key=lambda r: r[1]) == want


def test_rows_of_one_id_are_cut_into_ranges(spark, tmp_path):
    rows = [(None, f"{i % 97} tail {i}") for i in range(400)] + [(7, "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "t")
    tf.write_tokens(df, path, Path(PATH).read_text(encoding="utf-8"))
    sizes = [len(tf.read_footer(memoryview(bytes(r.content)))[3]) for r in tf.read_bytes(spark, path).collect()]
    assert len(sizes) > 2 and max(sizes) < 300 and sum(sizes) == 403
    assert got(df) == brute(rows)


def test_pieces_are_those_of_the_pattern():
    rng = random.Random(5)
    signs = ["'", "'s", "'re", "'ll", "'ve", "'t", "'r", " ", "  ", "\n", "\t", "\xa0", "a", "Z", "é", "ж", "7", "٣", "_", "-", "’", "€", "s", "l", "v", "e"]
    texts = ["", "'", " ", "a'", "x's", "'s", "'", "s", "\n\n", " 's", "\n's a", "''s's"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(20_000)]
    plain = [t for t in texts if tf.PLAIN.fullmatch(t)]
    codes, kind = tf.class_of(plain)
    pieces, number = tf.pieces_of("".join(plain).encode(), codes, kind, np.cumsum([0, *map(len, plain)]))
    want = [re.findall(tf.PATTERN, t) for t in plain]
    assert number.tolist() == [len(w) for w in want] and pieces.to_pylist() == [p for w in want for p in w]
    # All texts of a run at once, the plain ones among others.
    encoder = tf.Encoder(Path(PATH).read_text(encoding="utf-8"), tf.PATTERN)
    some = texts[:3000]
    assert [x.tolist() for x in encoder.encode(some)] == [x.tolist() for x in encoder.whole(some)]
    assert len(encoder.cut(some)[0]) < len(some) and [x.tolist() for x in encoder.encode([])] == []
