"""WARC archives of pages, compressed record by record with a shared dictionary.

An archive is cut into files of about ``FILE_BYTES``; a longer record is in a file of its own.
A file starts with a skippable Zstandard frame (magic 0x184D2A5D) that holds the dictionary; every
record is a frame of its own. The dictionary is trained on about ``SAMPLE`` records of at most
``SAMPLE_BYTES`` each, chosen by a hash; it affects the size of the files only.

A record's block is an HTTP response whose payload is the page's text in UTF-8. Of records with equal
payloads of ``REVISIT_BYTES`` or more, that with the largest page id is a response and the others
are revisits: they have the HTTP header, which tells the payload's length, its digest, and the id of
the response. Equal means equal SHA-1 and length.

A null text is an empty payload. A null url has no target line; line ends and blanks in a url are
percent-encoded. A null id is smaller than all others; rows that repeat the largest id are all
responses. An empty table gives no record. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.llm.byte_files import contents, read_bytes, write_bytes
from brambling.llm.common import HOT_SHARE, slices
from brambling.operators.joins import BROADCAST_BYTES, measure
from brambling.session import store

REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
LEVEL = 3
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 1 << 16, 112_640
# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RUN_BYTES = 8 << 20
# Bytes of a file, and rows of frames that the writer puts into one.
FILE_BYTES, FILE_ROWS = 64 << 20, 256


def _record(page_id: int | None, url: bytes | None, payload: bytes, sha1: str, refers: int | None, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers is not None else http + payload
    lines = [f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head = "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n"
    target = b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20]", lambda m: b"%%%02X" % m[0][0], url) + b"\r\n" if url is not None else b""
    return head.encode() + target + b"\r\n" + block + b"\r\n\r\n"


def _writer(dictionary: bytes, level: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of frames; every ``FILE_ROWS`` of them are a file, for which the last ones may be empty."""
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""

    def out(rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["frames"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=level)
        held, size, rows, written = [lead], 0, 0, 0

        for batch, payloads in slices(batches, "payload", RUN_BYTES):
            urls = [None if u is None else u.encode() for u in batch.column("url").to_pylist()]
            for row in zip(batch.column("page_id").to_pylist(), urls, payloads, batch.column("sha1").to_pylist(), batch.column("refers").to_pylist()):
                frame = compressor.compress(_record(*row, date))
                if written and written + size + len(frame) > FILE_BYTES:
                    yield out([b"".join(held)] + [b""] * (FILE_ROWS - rows - 1))
                    held, size, rows, written = [lead], 0, 0, 0
                held.append(frame)
                size += len(frame)
                if size * FILE_ROWS >= 2 * FILE_BYTES:
                    yield out([b"".join(held)])
                    held, size, rows, written = [], 0, rows + 1, written + size
        if size:
            yield out([b"".join(held)])

    return write


def _dictionary(rows: DataFrame, n: int) -> bytes:
    """Trained on whole records of a bounded sample; empty if there are too few to learn from."""
    share = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < min(1 << 30, (SAMPLE << 30) // max(1, n))
    some = rows.where(share & (F.octet_length("payload") <= SAMPLE_BYTES)).limit(2 * SAMPLE)
    records = [_record(r.page_id, r.url.encode() if r.url is not None else None, bytes(r.payload), r.sha1, None, DATE) for r in some.collect()]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, records)) // 8), records).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _with_response(rows: DataFrame, copies: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``last``, the id of the response that has the payload, null where no other row has it.

    Payloads stay where they are if the table of repeated ones is small, as measured. If not, those that
    make up much of all rows are few and broadcast; the others meet in a shuffle.
    """
    keys = ["sha1", "size"]
    if measure(copies)[1] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(copies.drop("n")), keys, "left")
    hot = copies.where(F.col("n") * HOT_SHARE > total).drop("n")
    cold = copies.where(F.col("n") * HOT_SHARE <= total).drop("n")
    rest = rows.join(F.broadcast(hot), keys, "left_anti").join(cold, keys, "left")
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> None:
    """Write one record per row to ``path``.

    The payloads are read three times: for their digests and lengths, which are stored, for the sample
    that the dictionary is trained on, and to be written.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    digests = store(rows.select("page_id", "sha1", "size"))
    copies = digests.where(F.col("size") >= revisit_bytes).groupBy("sha1", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    copies, total = store(copies.where("n > 1")), digests.count()
    # A row whose own id is the largest is the response.
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    records = _with_response(rows, copies, total).select("page_id", "url", "payload", "sha1", refers.alias("refers"))
    write_bytes(records.mapInArrow(_writer(_dictionary(rows, total), LEVEL, date), "frames binary"), path, FILE_ROWS)


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8", "replace").partition(": ")
        out[name.lower()] = value
    return out


def records_of(content: memoryview) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """``(record header, HTTP header, payload)`` of each record of one archive file."""
    magic, size = struct.unpack_from("<II", content)
    own = zstandard.ZstdCompressionDict(bytes(content[8 : 8 + size])) if magic == DICTIONARY_MAGIC else None
    raw = zstandard.ZstdDecompressor(dict_data=own).stream_reader(content, read_across_frames=True)
    stream = io.BufferedReader(raw, 1 << 18)
    while version := stream.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError(f"no record starts with {version[:40]!r}")
        record = _headers(stream)
        block = io.BufferedReader(io.BytesIO(stream.read(int(record["content-length"]))))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {record['warc-record-id']} does not end where its length says")
        block.readline()
        yield record, _headers(block), block.read()


def _page(urn: str | None) -> int | None:
    name = (urn or "<urn:x-page:null>").removeprefix("<urn:x-page:").removesuffix(">")
    return None if name == "null" else int(name)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        for content in contents(batch):
            for record, http, payload in records_of(content):
                digest = base64.b32decode(record["warc-payload-digest"].removeprefix("sha1:")).hex()
                if record["warc-type"] == "response" and (len(payload) != int(http["content-length"]) or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"the payload of {record['warc-record-id']} is not what its header says")
                rows.append((_page(record["warc-record-id"]), int(http["content-length"]), digest, record["warc-type"], _page(record.get("warc-refers-to"))))
                if len(rows) == 10_000:
                    yield out()
                    rows.clear()
    yield out()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per record.

    Payloads are hashed again; for a revisit, which has none, the header tells its length and digest.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return read_bytes(spark, path).mapInArrow(_read, schema)


ORACLE = f"""
WITH rows AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
last AS (SELECT payload_digest, payload_bytes, max(page_id) AS last FROM rows WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM rows LEFT JOIN last USING (payload_digest, payload_bytes)
"""
