"""WARC round trip and its checks."""

import base64
import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from ordermart.llm import warc
from ordermart.llm.common import corpus_session
from ordermart.session import scratch_path


def expected(rows):
    least = {}
    for p, _, html in rows:
        if p is not None:
            least[html or ""] = min(least.get(html or "", p), p)
    out = []
    for p, _, html in rows:
        body = (html or "").encode()
        first = least.get(html or "")
        revisit = p is not None and p > first
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows):
    corpus_session(spark)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn(
        "payload", F.lit(1)).repartition(3)
    path = scratch_path(spark, "warc")
    warc.write_archives(df, path)
    return warc.read_archives(spark, path).collect()


def test_round_trip(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}", "".join(rng.choice(["é", "a", "\r\n", "\r\n\r\n", "WARC/1.1\r\n", "0\r\n\r\n"])
                                         for _ in range(rng.choice([0, 5, 300, 9000])))) for i in range(60)]
    rows += [(100 + i, None, rows[i % 3][2]) for i in range(9)]
    rows += [(200, "http://a\r\nWARC-Type: x", None), (201, "u", ""), (None, "u", "same"), (None, "u", "same"), (5, "u", rows[5][2]),
             (202, "u", "z" * 300_000), (2, "u", "z" * 300_000)]
    out = round_trip(spark, rows)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == expected(rows)
    got = collections.Counter(bytes(r.payload).decode() for r in out if r.payload is not None)
    responses = collections.Counter()
    for r in out:
        if r.record_type == "response":
            responses[r.payload_digest] += 1
    want = collections.Counter({(h or ""): responses[base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()]
                                for _, _, h in rows})
    assert got == want


def members(data):
    """(offset, content) of the gzip members of a file."""
    import zlib

    at = 0
    while at < len(data):
        z = zlib.decompressobj(31)
        content = z.decompress(data[at:]) + z.flush()
        yield at, content
        at = len(data) - len(z.unused_data)


def test_ids_links_and_offsets(spark):
    """Every revisit refers to the id of a response in the archives, ids are unique and the same however the
    rows are partitioned, and each record is a gzip member that can be read alone."""
    import pathlib

    corpus_session(spark)
    rows = [(i, f"http://x/{i}", "page " * (i % 7) * (400 if i % 5 == 0 else 1)) for i in range(50)]
    rows += [(None, "u", "page "), (None, "u", "page "), (0, "v", ""), (0, "v", ""), (3, "w", "page " * 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for n in (1, 4):
        path = scratch_path(spark, "warc")
        warc.write_archives(df.repartition(n), path)
        records = []
        for f in pathlib.Path(path.removeprefix("file:")).glob("part-*"):
            data = f.read_bytes()
            for at, content in members(data):
                got = list(warc.parse(content))
                assert len(got) <= 1  # a record, or the separator
                records += got
        found.append(sorted((h[b"warc-record-id"], h.get(b"warc-refers-to"), h[b"warc-type"], block) for h, block in records))
        ids = [h[b"warc-record-id"] for h, _ in records]
        assert len(ids) == len(set(ids))
        responses = {h[b"warc-record-id"] for h, _ in records if h[b"warc-type"] == b"response"}
        links = [h[b"warc-refers-to"] for h, _ in records if h[b"warc-type"] == b"revisit"]
        assert len(links) > 30 and set(links) <= responses
    assert found[0] == found[1]


def test_revisit_without_its_response_raises(spark, tmp_path):
    corpus_session(spark)
    sha = hashlib.sha1(b"a").hexdigest()
    response, revisit = (warc.page_records(*x)[0] for x in ((1, "u", b"a", sha, None), (2, "u", b"a", sha, 1)))
    other = warc.page_records(1, "u", b"b", hashlib.sha1(b"b").hexdigest(), None)[0]
    wrong = revisit.replace(b"X-Payload-Length: 1", b"X-Payload-Length: 2")
    for name, records, ok in (("both", [response, revisit], True), ("lost", [revisit], False), ("other", [other, revisit], False),
                              ("length", [response, wrong], False)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.gz").write_bytes(b"".join(warc.member(r + b"\r\n\r\n") + warc.SEPARATOR for r in records))
        if ok:
            assert len(warc.read_archives(spark, f"file://{tmp_path / name}").collect()) == 2
        else:
            with pytest.raises(ValueError, match="revisits refer to"):
                warc.read_archives(spark, f"file://{tmp_path / name}")


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_chunked_framing():
    for n in (0, 1, warc.CHUNK, warc.CHUNK + 1, 3 * warc.CHUNK):
        assert warc.unchunked(warc.chunked(b"x" * n)) == b"x" * n
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"2\r\nabc\r\n0\r\n\r\n")


def test_broken_segments_raise(spark, tmp_path):
    corpus_session(spark)
    digest = hashlib.sha1(b"q" * 30_000).hexdigest()
    records = warc.page_records(1, "u", b"q" * 30_000, digest, None)
    assert len(records) > 3
    for name, kept in (("lost", records[:1] + records[2:]), ("short", records[:-1]), ("double", records + records[1:2])):
        folder = tmp_path / name
        folder.mkdir()
        import gzip
        (folder / "part-0.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in kept)))
        with pytest.raises(Exception, match="segments of"):
            warc.read_archives(spark, f"file://{folder}").collect()


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    out = e.queries()["op6_warc"](spark, sf).collect()
    assert sorted((tuple(r) for r in out), key=str) == expected(rows)
