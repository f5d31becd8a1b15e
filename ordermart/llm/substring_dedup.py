"""Substring dedup: Rabin-Karp hashes of every fixed-length word window,
counted per hash in Spark; repeated windows merge into removal intervals.

How it runs. Each task hashes the windows of a few thousand documents at a
time: with prefix sums S of ``word_hash * B^i`` (mod 2^64) the window at i
hashes to ``(S[i+k] - S[i]) * B^-i``, two independent lanes of it. Within such
a chunk only the earliest occurrence of a hash goes on (a passage shared by
very many documents is pre-aggregated to one entry per chunk); later ones are
known to be removable on the spot. The first lane deals hashes into buckets
whose number follows the corpus size, so one bucket is a bounded piece of
work; the second identifies the window inside the bucket. A bucket finds the
earliest occurrence of every hash and returns the starts of all others. The
starts go back packed by shard of documents, so a bucket returns few rows however
many documents it touches; a shard merges them to one row per document, which
is joined to its text, and the words are cut there.
Two windows are taken as equal when their second lanes and, between chunks, their buckets agree (64 bits inside
a chunk, 64 + log2(buckets) across), no text is compared again.

Cases. A null or empty text has no words and comes back empty. A null
``doc_id`` sorts before every id. Rows that share a ``doc_id`` are one document
for the order: a window is removed when it starts earlier in a smaller id or
earlier within the same id; the same start under the same id (a repeated row)
removes nothing, so repeated rows get equal results. Texts shorter than the
window lose nothing. An empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import (
    Texts, compress_texts, decompress, id_key, mix64, pack_u32, powers, rows_of, text_bytes, unpack_u32)

WINDOW = 20
#: Bytes of text hashed together in a task, and windows of one bucket (a task's working set, about 40 bytes each).
CHUNK_BYTES = 6_000_000
BUCKET_WINDOWS = 4_000_000
#: Fixed odd multipliers of the two hash lanes.
LANES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_PARTS = ("bucket int, n int, hashes binary, doc_ids binary, doc_prints binary, doc_counts binary, starts binary")
_PACKED = "shard int, doc_ids binary, doc_prints binary, doc_counts binary, starts binary"
_FOUND = "id_key long, print long, starts binary"


def _lane(words: np.ndarray, base: int, size: int) -> np.ndarray:
    """Hashes of the windows at 0..n-size of one run of word hashes."""
    up, down = powers(base, len(words)), powers(pow(base, -1, 2**64), len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
    return (sums[size:] - sums[:-size]) * down[:len(words) - size + 1]


def _grouped(doc: np.ndarray, starts: np.ndarray):
    """Runs of equal ``doc`` in order: (doc of the run, its slice)."""
    cuts = np.flatnonzero(np.diff(doc)) + 1
    edges = [0, *cuts.tolist(), len(doc)]
    return ((int(doc[a]), starts[a:b]) for a, b in zip(edges, edges[1:]) if b > a)


def _later(hashes: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """True for every entry whose hash also has an entry of a smaller rank."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.empty(len(h), bool)
    new[:1] = True
    np.not_equal(h[1:], h[:-1], out=new[1:])
    heads = np.flatnonzero(new)
    out = np.zeros(len(h), bool)
    if len(heads) == len(h):
        return out
    r = rank[order]
    least = np.repeat(np.minimum.reduceat(r, heads), np.diff(np.append(heads, len(h))))
    out[order] = r > least
    return out


def _window_parts(size: int, buckets: int):
    """Map side: chunks of documents -> one row per (chunk, bucket) of
    earliest occurrences, and rows (bucket -1) of starts already known to be later."""

    def emit(chunk: list):
        chunk.sort(key=lambda d: d[0])  # earliest ids first
        ids, prints = np.array([d[0] for d in chunk]), np.array([d[1] for d in chunk])
        t = Texts([d[2] for d in chunk])
        spans = t.words()
        h, counts = t.hashes(*spans), np.bincount(t.owner(spans[0]), minlength=len(chunk))
        if len(h) < size:
            return []
        doc = np.repeat(np.arange(len(chunk)), counts)
        start = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.flatnonzero(start + size <= counts[doc])
        deal, key = (_lane(x, base, size)[at] for x, base in ((h, LANES[0]), (mix64(h), LANES[1])))
        doc, start = doc[at], start[at]
        dense = np.unique(ids, return_inverse=True)[1].astype(np.uint64)
        later = _later(key, (dense[doc] << np.uint64(32)) | start.astype(np.uint64))
        bucket = ((deal >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        rows = []
        for d, s in _grouped(doc[later], start[later]):
            rows.append((-1, len(s), b"", ids[d:d + 1].tobytes(), prints[d:d + 1].tobytes(), b"",
                         s.astype(np.uint32).tobytes()))
        keep = np.flatnonzero(~later)
        keep = keep[np.argsort(bucket[keep], kind="stable")]
        edges = np.searchsorted(bucket[keep], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = keep[edges[b]:edges[b + 1]]
            heads = np.append(0, np.flatnonzero(np.diff(doc[part])) + 1)
            which = doc[part][heads]
            rows.append((b, len(part), key[part].tobytes(), ids[which].tobytes(), prints[which].tobytes(),
                         pack_u32(np.diff(np.append(heads, len(part)))),
                         pack_u32(np.diff(start[part], prepend=0).astype(np.int32).view(np.uint32))))
        return rows

    def batches_of(rows):
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
        names = ["bucket", "n", "hashes", "doc_ids", "doc_prints", "doc_counts", "starts"]
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows[i:i + 64]), kinds)], names)

    def parts(batches):
        chunk, n = [], 0
        for key, fp, text in rows_of(batches, "id_key", "print", "text"):
            chunk.append((key, fp, text))
            n += len(text)
            if n >= CHUNK_BYTES:
                yield from batches_of(emit(chunk))
                chunk, n = [], 0
        if chunk:
            yield from batches_of(emit(chunk))

    return parts


def _by_shard(ids, prints, doc, start, shards: int) -> pd.DataFrame:
    """Starts of documents (``doc`` numbers them, in runs) packed to one row per shard of documents."""
    heads = np.append(0, np.flatnonzero(np.diff(doc)) + 1) if len(doc) else np.empty(0, np.int64)
    which, counts = doc[heads], np.diff(np.append(heads, len(doc)))
    shard = (mix64(ids.view(np.uint64) ^ mix64(prints.view(np.uint64)))[which] % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    by_window = np.argsort(np.repeat(shard, counts), kind="stable")
    start, which, counts = start[by_window].astype(np.uint32), which[order], counts[order].astype(np.uint32)
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    ends = np.append(0, np.cumsum(counts, dtype=np.int64))
    rows = [(s, ids[which[a:b]].tobytes(), prints[which[a:b]].tobytes(), counts[a:b].tobytes(),
             start[ends[a]:ends[b]].tobytes()) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
    return pd.DataFrame(rows, columns=["shard", "doc_ids", "doc_prints", "doc_counts", "starts"])


def _later_starts(shards: int):
    """One bucket: the starts of all windows that also start earlier."""

    def later_starts(group: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(group["doc_ids"]), np.int64)
        prints = np.frombuffer(b"".join(group["doc_prints"]), np.int64)
        if group["bucket"].iloc[0] < 0:  # known on the map side, a document a row
            doc = np.repeat(np.arange(len(ids)), group["n"].to_numpy())
            return _by_shard(ids, prints, doc, np.frombuffer(b"".join(group["starts"]), np.uint32), shards)
        key = np.frombuffer(b"".join(group["hashes"]), np.uint64)
        counts = np.concatenate([unpack_u32(c, len(i) // 8) for c, i in zip(group["doc_counts"], group["doc_ids"])])
        start = np.concatenate([np.cumsum(unpack_u32(s, n).view(np.int32)) for s, n in zip(group["starts"], group["n"])])
        doc = np.repeat(np.arange(len(ids)), counts)
        dense = np.unique(ids, return_inverse=True)[1].astype(np.uint64)
        later = _later(key, (dense[doc] << np.uint64(32)) | start.astype(np.uint64))
        return _by_shard(ids, prints, doc[later], start[later], shards)

    return later_starts


def _by_document(group: pd.DataFrame) -> pd.DataFrame:
    """One shard: a row per document with all its starts."""
    ids = np.frombuffer(b"".join(group["doc_ids"]), np.int64)
    prints = np.frombuffer(b"".join(group["doc_prints"]), np.int64)
    ends = 4 * np.cumsum(np.frombuffer(b"".join(group["doc_counts"]), np.uint32), dtype=np.int64)
    starts = b"".join(group["starts"])
    found: dict[tuple, list] = {}
    for i, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())):
        found.setdefault((ids[i], prints[i]), []).append(starts[a:b])
    return pd.DataFrame([(i, p, b"".join(s)) for (i, p), s in found.items()], columns=["id_key", "print", "starts"])


def repeated_windows(docs: DataFrame, size: int = WINDOW, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Starts (uint32) of every window that also starts earlier, by document:
    (id_key, print, starts). ``docs``:
    id_key long, print long (a fingerprint of the text), text binary."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(2**31 - 1, total // (6 * bucket_windows) + 1))  # a word and its space take about six bytes
    parts = docs.mapInArrow(_window_parts(size, buckets), _PARTS)
    known = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("doc_ids"), F.lit(max(64, buckets))).cast("int"))
    # as many partitions as groups, however many the session's shuffles have: few groups share a task
    return (parts.withColumn("bucket", F.coalesce(known, "bucket")).repartition(2 * buckets + 64, "bucket")
            .groupBy("bucket").applyInPandas(_later_starts(buckets), _PACKED)
            .repartition(max(16, buckets), "shard").groupBy("shard").applyInPandas(_by_document, _FOUND))


def _cut(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        ("kept", pa.binary())])

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, blob, starts in rows_of([batch], "doc_id", "ztext", "starts"):
                words = decompress(blob).split()
                step = np.zeros(len(words) + 1, np.int32)
                if starts:
                    s = np.frombuffer(starts, np.uint32).astype(np.int64)
                    np.add.at(step, s, 1)
                    np.add.at(step, s + size, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                if spans:
                    kept, at = [], 0
                    for s in spans:
                        kept += words[at:s["start"]]
                        at = s["end"]
                    kept += words[at:]
                else:
                    kept = words
                out.append((doc_id, len(words), int(gone.sum()), spans, b" ".join(kept)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return cut


def remove_repeats(documents: DataFrame, size: int = WINDOW, bucket_windows: int = BUCKET_WINDOWS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words of windows that also start earlier:
    (doc_id, n_words, n_removed, spans of removed words, kept_text)."""
    docs = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), id_key(F.col(id_col)).alias("id_key"),
        text_bytes(F.col(text_col)).alias("text")).withColumn("print", F.xxhash64("text"))
    found = repeated_windows(docs.select("id_key", "print", "text"), size, bucket_windows)
    joined = compress_texts(docs, "text").join(found, ["id_key", "print"], "left")
    return joined.select("doc_id", "ztext", "starts").mapInArrow(
        _cut(size), "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
    ).withColumn("kept_text", F.col("kept").cast("string")).drop("kept")
