"""WARC archives of pages: written, read back, segments reassembled, revisits followed.

Writing. Of pages with equal payloads (by SHA-1, at least ``MIN_REVISIT`` bytes)
the one of smallest id is a ``response`` record, the others are ``revisit``
records that refer to its record id. A record id is made of page id and payload digest (and a
counter for rows that repeat both), so it is the same however the table is partitioned, and what a
revisit refers to is a record of the archives. A response holds an HTTP message whose body is in
chunked transfer framing; one longer than ``SEGMENT`` bytes is cut into a first
record and ``continuation`` records with the first one's id, ascending segment
numbers, and the total length on the last. Every record is a gzip member of its own, so
it can be read alone from its offset. Spark's text writer writes the members as lines; its line separator is
an empty gzip member. A file holds at most ``FILE_RECORDS`` records, so no file is large however long a page is.

Reading. A file is unpacked and parsed once, by its records' declared lengths. Whole
records are decoded and checked where they are read. Segments, which may lie in different files, are
grouped by origin id, ordered by segment number and checked: numbers gapless from
1, the lengths' sum equal to the declared total. Then the chunked framing is
decoded and the payload checked against its digest. Revisits are joined to the responses they refer to (one row
for all revisits of a response): each must be there and have the revisit's digest and length. Anything wrong raises.

Cases. A null or empty html is an empty payload (equal to other empty ones). A row
with a null page id is a response of its own. Rows that repeat an id are written
each; with equal payloads both are responses if theirs is the smallest id (they are numbered by url in one sorted
stream for an id and payload, which holds no more than a row at a time). A null url
is written as empty, line ends in it are percent-encoded. An empty table
gives no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.llm.common import rows_of, sliced
from ordermart.session import cut_lineage, discard_cut

MIN_REVISIT = 0
SEGMENT = 8192
CHUNK = 4096
FILE_RECORDS = 2000
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = re.compile(rb"<urn:page:(-?\d+|null):[^>]*>")


def member(data: bytes) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: What lies between two records: an empty gzip member.
SEPARATOR = member(b"")


def typed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary), digest (SHA-1 hex), refers_to (null: a response) and
    copy (1, 2, ... among rows of equal id and payload)."""
    df = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                      F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    df = df.withColumn("digest", F.sha1("payload"))
    per = cut_lineage(df.groupBy("page_id", "digest").agg(
        F.max(F.octet_length("payload")).alias("size"), F.count(F.lit(1)).alias("n")))
    shared = (per.where((F.col("size") >= MIN_REVISIT) & F.col("page_id").isNotNull())
              .groupBy("digest").agg(F.min("page_id").alias("least"), F.max("page_id").alias("most"))
              .where("least < most").select("digest", "least"))
    again = per.where("n > 1").select(F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest"))
    if again.isEmpty():
        df = df.withColumn("copy", F.lit(1))
    else:
        repeated = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("digest") == F.col("of_digest"))
        numbered = df.join(again, repeated, "left_semi").withColumn(
            "copy", F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url")))
        df = df.join(again, repeated, "left_anti").withColumn("copy", F.lit(1)).unionByName(numbered)
    return df.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") > F.col("least"), F.col("least")).alias("refers_to"), "copy")


def chunked(body: bytes) -> bytes:
    parts = []
    for i in range(0, len(body), CHUNK):
        piece = body[i:i + CHUNK]
        parts += [b"%x" % len(piece), _END, piece, _END]
    return b"".join([*parts, b"0", _END, _END])


def unchunked(data: bytes) -> bytes:
    """The body of a message in chunked transfer framing (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        stop = data.index(_END, at)
        size = int(data[at:stop].split(b";")[0], 16)
        at = stop + 2
        if not size:
            return b"".join(out)
        if data[at + size:at + size + 2] != _END:
            raise ValueError("chunk without its line end")
        out.append(data[at:at + size])
        at += size + 2


def record(headers: dict[str, object], block: bytes) -> bytes:
    """A record up to, not including, its two closing line ends."""
    head = "".join(f"{k}: {v}\r\n" for k, v in {**headers, "Content-Length": len(block)}.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + _END + block


def record_id(page: int | None, sha: str, copy: int = 1) -> str:
    return f"urn:page:{'null' if page is None else page}:{sha}" + (f";{copy}" if copy > 1 else "")


def page_records(page: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, copy: int = 1) -> list[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    url = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    base = {"WARC-Date": DATE, "WARC-Target-URI": url}
    bare = base64.b32encode(bytes.fromhex(digest)).decode()
    name, sha = record_id(page, bare, copy), "sha1:" + bare
    kind = "application/http; msgtype=response"
    if refers_to is not None:
        return [record({"WARC-Type": "revisit", "WARC-Record-ID": f"<{name}>", **base, "WARC-Profile": _PROFILE,
                        "WARC-Refers-To": f"<{record_id(refers_to, bare)}>", "WARC-Payload-Digest": sha,
                        "X-Payload-Length": len(payload), "Content-Type": kind}, _HTTP)]
    block = _HTTP + chunked(payload)
    parts = [block[i:i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    many = len(parts) > 1
    out = [record({"WARC-Type": "response", "WARC-Record-ID": f"<{name}>", **base, "WARC-Payload-Digest": sha,
                   "WARC-Segment-Number": 1 if many else None, "Content-Type": kind}, parts[0])]
    for k, part in enumerate(parts[1:], 2):
        out.append(record({"WARC-Type": "continuation", "WARC-Record-ID": f"<{name}:{k}>", **base,
                           "WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Number": k,
                           "WARC-Segment-Total-Length": len(block) if k == len(parts) else None}, part))
    return out


def write_archives(pages: DataFrame, path: str) -> None:
    """Write all pages as WARC files under ``path``."""

    def records(batches):
        for b in sliced(batches, "payload"):
            out = [member(r + b"\r\n\r\n")
                   for row in rows_of([b], "page_id", "url", "payload", "digest", "refers_to", "copy") for r in page_records(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (typed_pages(pages).mapInArrow(records, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse(data: bytes):
    """(headers, block) of the records of an unpacked archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:stop].split(_END)
        if not first.startswith(b"WARC/1."):
            raise ValueError("no record where one should begin")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines)}
        size = int(headers[b"content-length"])
        block = data[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4
        if len(block) != size or data[at - 4:at] != b"\r\n\r\n":
            raise ValueError("record of another length than declared")
        yield headers, block


def _unpacked(content: bytes) -> bytes:
    out = []
    while content:  # one gzip member after the other
        z = zlib.decompressobj(31)
        out += [z.decompress(content), z.flush()]
        content = z.unused_data
    return b"".join(out)


_RECORD = pa.schema([("id", pa.binary()), ("type", pa.binary()), ("segment", pa.int32()), ("total", pa.int64()),
                     ("digest", pa.binary()), ("refers_to", pa.binary()), ("bytes", pa.int64()), ("block", pa.binary())])
_RECORD_SQL = "id binary, type binary, segment int, total long, digest binary, refers_to binary, bytes long, block binary"


def _body(name: bytes, digest: bytes, block: bytes) -> bytes:
    """The payload of a whole response, checked against its digest."""
    body = unchunked(block[block.index(b"\r\n\r\n") + 4:])
    if b"sha1:" + base64.b32encode(hashlib.sha1(body).digest()) != digest:
        raise ValueError(f"payload of {name!r} has another digest")
    return body


def read_records(spark: SparkSession, path: str, payload: bool) -> DataFrame:
    """The records of all archives, whole ones decoded (``block``: the payload if wanted), segments as they are; ``id`` is the origin's."""

    def read(batches):
        whole = lambda v: None if v is None else int(v)
        for (content,) in rows_of(batches, "content"):
            out = []
            for h, block in parse(_unpacked(content)):
                name, kind, digest = h[b"warc-record-id"], h[b"warc-type"], h.get(b"warc-payload-digest")
                size, segment = whole(h.get(b"x-payload-length")), whole(h.get(b"warc-segment-number"))
                if segment is None:
                    block = _body(name, digest, block) if kind == b"response" else None
                    size = size if block is None else len(block)
                    block = block if payload else None
                out.append((h.get(b"warc-segment-origin-id", name), kind, segment, whole(h.get(b"warc-segment-total-length")),
                            digest, h.get(b"warc-refers-to"), size, block))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RECORD)], schema=_RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, _RECORD_SQL)


_FOUND = pa.schema([("id", pa.binary()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("to", pa.binary()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _decode(payload: bool):
    def page(ref: bytes | None) -> int | None:
        found = _PAGE.fullmatch(ref or b"<urn:page:null:>")
        return None if found[1] == b"null" else int(found[1])

    def decode(batches):
        for b in sliced(batches, "id", 64_000):
            out = []
            for name, parts in rows_of([b], "id", "parts"):
                parts = sorted(parts, key=lambda p: p["segment"] or 1)
                first = parts[0]
                body, size = first["block"], first["bytes"]
                if len(parts) > 1 or first["segment"]:
                    block = b"".join(p["block"] for p in parts if p["segment"])
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                        raise ValueError(f"segments of {name!r} are missing or double")
                    if parts[-1]["total"] != len(block):
                        raise ValueError(f"segments of {name!r} have another length than declared")
                    body = _body(name, first["digest"], block)
                    size = len(body)
                out.append((name, page(name), size, first["digest"].removeprefix(b"sha1:").decode(), first["type"].decode(),
                            first["refers_to"], page(first["refers_to"]), body if payload else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)

    return decode


def unresolved(records: DataFrame) -> DataFrame:
    """Revisits (counted by what they refer to, digest and length) without a response of that id, digest and length."""
    wanted = records.where("record_type = 'revisit'").groupBy("to", "payload_digest", "payload_bytes").agg(F.count(F.lit(1)).alias("n"))
    there = records.where("record_type = 'response'").select(F.col("id").alias("to"), "payload_digest", "payload_bytes")
    return wanted.join(there, ["to", "payload_digest", "payload_bytes"], "left_anti")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per page of the archives: page_id, payload_bytes, payload_digest (base32
    SHA-1), record_type, refers_to, and the payload (null for a revisit: its response has it)."""
    part = F.struct("type", "segment", "total", "digest", "refers_to", "bytes", "block")
    grouped = read_records(spark, path, payload).groupBy("id").agg(F.collect_list(part).alias("parts"))
    found = cut_lineage(grouped.mapInArrow(_decode(payload), (
        "id binary, page_id long, payload_bytes long, payload_digest string, record_type string, to binary, refers_to long, payload binary")))
    lost = unresolved(found).first()
    if lost:
        discard_cut(found)
        raise ValueError(f"{lost['n']} revisits refer to {bytes(lost['to'])!r}, which is no response of their digest and length")
    return found.drop("id", "to", *([] if payload else ["payload"]))
