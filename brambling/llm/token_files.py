"""Token ids of documents in binary files of compressed bit or byte planes.

Documents are dealt out by ranges of their id, so that the files in order hold them in ascending
order. A file is a run of chunks and a footer. A chunk holds up to ``BLOCK`` ids of the file's id
stream: the ids' bytes (or bits) are transposed into planes, the first plane holding the lowest
byte (bit) of each id, and each plane is compressed with Zstandard. The footer has the index: the
place and number of ids of each chunk, and each document's id and number of tokens. Integers are
little-endian. ``SEPARATOR`` follows every chunk and the footer.

    chunk   "PLN1"  u32 ids  u8 planes  { u32 length, Zstandard frame } per plane
    footer  "PLNX"  u32 part  Zstandard frame of: u64 chunks, u64 documents, i64 chunk offsets,
            i64 chunk ids, u8 document id is null, i64 document ids, i64 document tokens
    tail    u64 length of the footer  "PLNE"

Every document ends with ``END``. A null text is empty, so it has that one token. A null id comes
first. Rows that repeat an id follow each other, by text; equal rows stay as many as they are. An
empty table gives no documents. Other columns are ignored.

The tokenizer comes as the contents of its file and travels with the job. Texts are cut by the
tokenizer's own pattern, and each distinct piece is encoded once by the tokenizers library and
remembered, up to a bound; texts with characters beyond ``PLAIN`` are encoded by it as a whole. Without
a pattern all texts are, which suits any tokenizer of that library. With ``special`` the string of a
special token gives that token's id, as the library does by default; otherwise it is ordinary text.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brambling.llm.byte_files import SEPARATOR, contents, read_bytes, write_bytes
from brambling.llm.common import slices
from brambling.session import scratch_path, store

END = 2
BLOCK = 1 << 16
LEVEL = 3
FILE_BYTES = 64 << 20
RUN_BYTES = 4 << 20
# Characters that are cut into pieces at a time.
PART_CHARS = 1 << 18
PIECES, PIECE_IDS = 400_000, 2_400_000
JOINED = 512
RANGE_CHARS = 64
# Fixed value: how the byte-level tokenizer cuts a text before it merges bytes, for texts of PLAIN
# characters: contractions, letters, digits, other signs, each after a blank or not, and blanks.
PATTERN = r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
# Characters of Latin, Greek and Cyrillic texts, without signs of which Python's and the tokenizer's
# classes differ.
PLAIN = re.compile("[\x00-\x1b\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u0386\u0388-\u038a\u038e-\u03a1\u03a3-\u03ce\u0400-\u0482\u048a-\u052f\u2010-\u2027\u2030-\u203e\u20ac]*")

# Classes of characters in PATTERN; 0 is for those beyond PLAIN.
LETTER, DIGIT, SIGN, WHITE, BLANK = range(1, 6)


@cache
def classes() -> np.ndarray:
    """By code point, the class; the last place is for all code points behind it."""

    def of(c: str) -> int:
        if not PLAIN.fullmatch(c):
            return 0
        return BLANK if c == " " else WHITE if re.match(r"\s", c) else DIGIT if re.match(r"\d", c) else LETTER if re.match(r"[^\W\d_]", c) else SIGN

    return np.array([of(chr(k)) for k in range(0x20AD)] + [0], np.uint8)


def class_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in order, and their classes."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    known = classes()
    return codes, known[np.minimum(codes, len(known) - 1)]


def pieces_of(data: bytes, codes: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """What ``PATTERN`` finds in plain texts, in order, and how many pieces each text has.

    Texts follow each other in ``data``, ``bounds`` are their first and last ends in characters. Every
    character belongs to a piece, so the pieces are where they begin.
    """
    n = len(kind)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(len(bounds) - 1, np.int64)
    fresh = np.zeros(n + 1, bool)
    fresh[bounds] = True
    group = np.minimum(kind, WHITE)
    begin = fresh[:n].copy()
    begin[1:] |= (group[1:] != group[:-1]) & (kind[:-1] != BLANK)
    white = group == WHITE
    # White space before something else gives its last character away, a blank to the piece behind it.
    begin[1:] |= white[1:] & ~white[:-1]
    last = white.copy()
    last[:-1] &= ~white[1:]
    begin |= last & ~fresh[1:]
    # A sign that a blank precedes has begun with it, and does not begin a contraction.
    mark = np.flatnonzero((codes == ord("'")) & begin)
    room = np.searchsorted(bounds, mark, side="right")
    room = bounds[room] - mark
    one, two = (codes[np.minimum(mark + k, n - 1)] for k in (1, 2))
    size = np.zeros(len(mark), np.int64)
    for tail in ("s", "t", "m", "d", "re", "ve", "ll"):
        size[(one == ord(tail[0])) & (room > len(tail)) & (len(tail) == 1 or two == ord(tail[-1]))] = 1 + len(tail)
    mark, size = mark[size > 0], size[size > 0]
    begin[mark + 1] = False
    ends = mark + size
    begin[ends[ends < n]] = True
    start = np.flatnonzero(begin)
    places = start
    if len(data) > n:
        width = np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800))
        places = np.concatenate([[0], width])[start]
    offsets = np.append(places, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))
    return pieces, np.diff(np.searchsorted(start, bounds))


class Encoder:
    """Ids of texts, remembering pieces that have been encoded before, the most used ones longest."""

    def __init__(self, tokenizer: str, pattern: str | None, special: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = not special
        # A text with the string of a token that the library takes out before it cuts is encoded as a whole.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        self.added = added
        self.pattern, self.pieces = pattern, re.compile(pattern).findall if pattern else None
        # A byte-level token has one sign per byte.
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.known = pa.array([], pa.large_string())
        self.start, self.length, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)

    @property
    def place(self) -> dict[str, int]:
        """The pieces that are remembered now."""
        return {p: k for k, p in enumerate(self.known.to_pylist())}

    @classmethod
    def kept(cls, tokenizer: str, pattern: str | None, special: bool = False) -> Encoder:
        """The encoder of this worker process, which the tasks that it runs one after another share."""
        import tokenizers

        held, key = vars(tokenizers).setdefault("_kept_encoder", {}), (tokenizer, pattern, special)
        if key not in held:
            held.clear()
            held[key] = cls(tokenizer, pattern, special)
        return held[key]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def apart(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of pieces, in order, and how many each has."""
        found = self.whole(texts)
        return found, np.array([len(x) for x in found], np.int64)

    def words(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """``apart`` for pieces that are a blank and letters; side by side they are cut in the same places."""
        out, lengths = [], [np.zeros(0, np.int64)]
        for k in range(0, len(words), JOINED):
            own = words[k : k + JOINED]
            (ids,) = self.whole(["".join(own)])
            ends = np.cumsum([len(w.encode()) for w in own])
            reached = np.cumsum(self.width[ids])
            at = np.searchsorted(reached, ends)
            if len(reached) and reached[-1] == ends[-1] and (reached[at] == ends).all():
                out.append(ids)
                lengths.append(np.diff(at, prepend=-1))
            else:
                found, number = self.apart(own)
                out += found
                lengths.append(number)
        return out, np.concatenate(lengths)

    def learn(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Remember new pieces; where each is then."""
        # Words first: a blank and letters.
        plain = np.asarray(pc.fill_null(pc.match_substring_regex(pieces, r"^ \pL+$"), False))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        words, others = pieces.filter(pa.array(plain)), pieces.filter(pa.array(~plain))
        (ids, lengths), (more, last) = self.words(words.to_pylist()), self.apart(others.to_pylist())
        lengths = np.concatenate([lengths, last])
        place = np.empty(len(pieces), np.int64)
        place[order] = len(self.known) + np.arange(len(pieces))
        self.known = pa.concat_arrays([self.known, words, others])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.ids = np.concatenate([self.ids, *ids, *more])
        self.uses = np.concatenate([self.uses, np.zeros(len(lengths), np.int64)])
        return place

    def forget(self) -> None:
        """Keep the half of the pieces that was used most, within half of the ids."""
        order = np.argsort(-self.uses, kind="stable")[: PIECES // 2]
        order = np.sort(order[np.cumsum(self.length[order]) <= PIECE_IDS // 2])
        self.known = self.known.take(pa.array(order))
        length = self.length[order]
        ends = np.cumsum(length)
        self.ids = self.ids[np.repeat(self.start[order] - ends + length, length) + np.arange(int(length.sum()))]
        self.start, self.length, self.uses = ends - length, length, self.uses[order] // 2

    def find(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Where distinct pieces are among those remembered, after learning those that are not."""
        found = pc.index_in(pieces, value_set=self.known)
        if found.null_count and (len(self.known) > PIECES or len(self.ids) > PIECE_IDS):
            self.forget()
            found = pc.index_in(pieces, value_set=self.known)
        new = np.asarray(found.is_null())
        place = np.asarray(pc.fill_null(found, 0)).astype(np.int64)
        if new.any():
            place[new] = self.learn(pieces.filter(pa.array(new)))
        return place

    def cut(self, texts: list[str]) -> tuple[list[int], pa.LargeStringArray, np.ndarray]:
        """Which texts are cut into pieces, the pieces of all of these, and how many each has."""
        if not self.pieces:
            return [], pa.array([], pa.large_string()), np.zeros(0, np.int64)
        codes, kind = class_of(texts)
        ends = np.cumsum([len(t) for t in texts])
        plain = np.ones(len(texts), bool)
        plain[np.searchsorted(ends, np.flatnonzero(kind == 0), side="right")] = False
        for a in self.added:
            plain &= [a not in t for t in texts]
        chosen = np.flatnonzero(plain).tolist()
        own = [texts[i] for i in chosen]
        if self.pattern != PATTERN:
            found = [pa.array(self.pieces(t), pa.large_string()) for t in own]
            return chosen, pa.concat_arrays([self.known.slice(0, 0), *found]), np.array([len(x) for x in found], np.int64)
        if not plain.all():
            kept = np.repeat(plain, np.diff(ends, prepend=0))
            codes, kind = codes[kept], kind[kept]
        bounds = np.cumsum([0, *map(len, own)])
        return chosen, *pieces_of("".join(own).encode(), codes, kind, bounds)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        part = np.cumsum([0, *map(len, texts)])[:-1] // PART_CHARS
        firsts = np.flatnonzero(np.diff(part, prepend=-1))
        cut = [self.cut(texts[a:b]) for a, b in zip(firsts, [*firsts[1:], len(texts)])]
        # Each distinct piece of the run is looked up once.
        named = pa.concat_arrays([self.known.slice(0, 0), *[pieces for _, pieces, _ in cut]]).dictionary_encode()
        place, named = self.find(named.dictionary), named.indices.to_numpy()
        self.uses += np.bincount(place, np.bincount(named, minlength=len(place)), len(self.uses)).astype(np.int64)
        done = 0
        for first, (plain, pieces, number) in zip(firsts, cut):
            every = place[named[done : done + len(pieces)]]
            done += len(pieces)
            length = self.length[every]
            ends = np.cumsum(length)
            at = np.repeat(self.start[every] - ends + length, length)
            at += np.arange(len(at))
            ids = self.ids.take(at)
            bounds = np.append(0, ends)[np.append(0, np.cumsum(number))]
            for i, a, b in zip(plain, bounds, bounds[1:]):
                out[first + i] = ids[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = ids
        return out


def pack_chunk(ids: np.ndarray, bits: bool = False) -> bytes:
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if bits:
        each = np.unpackbits(planes[:, :, None], axis=2, bitorder="little")
        planes = np.packbits(each.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    frames = [compressor.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    return struct.pack("<4sIB", b"PLN1", len(ids), len(frames)) + b"".join(struct.pack("<I", len(f)) + f for f in frames)


def unpack_chunk(chunk: memoryview) -> np.ndarray:
    magic, n, count = struct.unpack_from("<4sIB", chunk)
    if magic != b"PLN1":
        raise ValueError("no chunk starts here")
    planes, at = [], 9
    for _ in range(count):
        (size,) = struct.unpack_from("<I", chunk, at)
        planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(chunk[at + 4 : at + 4 + size]), np.uint8))
        at += 4 + size
    if count == 32:
        each = np.unpackbits(np.array(planes), axis=1, bitorder="little")[:, :n].reshape(4, 8, n)
        planes = list(np.packbits(each, axis=1, bitorder="little")[:, 0])
    return np.ascontiguousarray(np.array(planes).T).reshape(-1).view("<u4")


def _footer(part: int, offsets: list[int], sizes: list[int], docs: list[int | None], tokens: list[int]) -> bytes:
    nulls = np.array([d is None for d in docs], np.uint8)
    known = np.array([0 if d is None else d for d in docs], "<i8")
    arrays = [np.array([len(offsets), len(docs)], "<u8"), np.array(offsets, "<i8"), np.array(sizes, "<i8"), nulls, known, np.array(tokens, "<i8")]
    body = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(a.tobytes() for a in arrays))
    footer = struct.pack("<4sI", b"PLNX", part) + body
    return footer + struct.pack("<Q4s", len(footer), b"PLNE")


def read_footer(content: memoryview) -> tuple[int, np.ndarray, np.ndarray, list[int | None], np.ndarray]:
    """``(part, chunk offsets, chunk ids, document ids, document tokens)``."""
    end = len(content) - len(SEPARATOR) - 12
    size, magic = struct.unpack_from("<Q4s", content, end)
    if magic != b"PLNE":
        raise ValueError("the file has no footer")
    _, part = struct.unpack_from("<4sI", content, end - size)
    body = zstandard.ZstdDecompressor().decompress(content[end - size + 8 : end])
    chunks, docs = (int(x) for x in np.frombuffer(body, "<u8", 2))
    at, out = 16, []
    for kind, n in (("<i8", chunks), ("<i8", chunks), ("u1", docs), ("<i8", docs), ("<i8", docs)):
        out.append(np.frombuffer(body, kind, n, at))
        at += out[-1].nbytes
    ids = [None if null else int(d) for null, d in zip(out[2], out[3])]
    return part, out[0], out[1], ids, out[4]


def _writer(tokenizer: str, pattern: str | None, end: int, bits: bool, special: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.kept(tokenizer, pattern, special)
        offsets, sizes, docs, tokens = [], [], [], []
        held, place = np.zeros(0, np.uint32), 0

        def emit(ids: np.ndarray) -> bytes:
            nonlocal place
            chunk = pack_chunk(ids, bits)
            offsets.append(place)
            sizes.append(len(ids))
            place += len(chunk) + len(SEPARATOR)
            return chunk

        for batch, texts in slices(batches, "text", RUN_BYTES):
            encoded = encoder.encode([t.decode("utf-8", "replace") for t in texts])
            # The pieces of a run take many times its size; two tasks need not hold them until their end.
            pa.default_memory_pool().release_unused()
            docs += batch.column("doc_id").to_pylist()
            tokens += [len(ids) + 1 for ids in encoded]
            parts = [held]
            for ids in encoded:
                parts += [ids, np.array([end], np.uint32)]
            held = np.concatenate(parts)
            full = len(held) // BLOCK * BLOCK
            out = [emit(held[i : i + BLOCK]) for i in range(0, full, BLOCK)]
            held = held[full:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["chunk"])
        if docs:
            out = [emit(held)] if len(held) else []
            out.append(_footer(TaskContext.get().partitionId(), offsets, sizes, docs, tokens))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["chunk"])

    return write


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", pattern: str | None = PATTERN, end: int = END, bits: bool = False, special: bool = False) -> None:
    """Encode and write all documents in ascending order of their ids, a file per range of ids and, within an id, of texts."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_BYTES))
    # Rows that repeat an id are cut into ranges by how their texts begin, in the order of the texts.
    begin = F.left("text", F.lit(RANGE_CHARS))
    dealt = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), begin).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    write_bytes(dealt.mapInArrow(_writer(tokenizer, pattern, end, bits, special), "chunk binary"), path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in contents(batch):
            part, offsets, _, docs, tokens = read_footer(content)
            bounds = np.concatenate([[0], np.cumsum(tokens)])
            sums = np.zeros(len(docs), np.int64)
            at, doc = 0, 0
            for offset in offsets:
                raw = memoryview(unpack_chunk(content[offset:]).tobytes())
                n = len(raw) // 4
                first = doc
                while doc < len(docs) and bounds[doc] < at + n:
                    a, b = max(0, int(bounds[doc]) - at), min(n, int(bounds[doc + 1]) - at)
                    sums[doc] = zlib.crc32(raw[4 * a : 4 * b], int(sums[doc]))
                    doc += 1
                if doc > first and bounds[doc] > at + n:
                    doc -= 1  # goes on in the next chunk
                at += n
            if at != bounds[-1]:
                raise ValueError("the file's ids are not as many as its index says")
            arrays = [np.full(len(docs), part, np.int32), bounds[:-1], tokens, sums]
            columns = [pa.array(docs, pa.int64()), *map(pa.array, arrays)]
            for k in range(0, len(docs), 10_000):
                yield pa.RecordBatch.from_arrays([c.slice(k, 10_000) for c in columns], names=["doc_id", "part", "inside", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document of the files at ``path``."""
    rows = store(read_bytes(spark, path).mapInArrow(_read, "doc_id long, part int, inside long, n_tokens long, ids_crc32 long"))
    # One row per file: a bounded table.
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", before.alias("before"))
    joined = rows.join(F.broadcast(sizes), "part")
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokens_of(docs: DataFrame, tokenizer_path: str, **options: object) -> DataFrame:
    """Write the documents' token files to the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, Path(tokenizer_path).read_text(encoding="utf-8"), **options)
    return read_tokens(docs.sparkSession, path)
