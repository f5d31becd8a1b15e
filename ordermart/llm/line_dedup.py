"""Line dedup: two Bloom filters of line hashes, once-seen and twice-seen; only
the lines that the second one suspects shuffle, for exact confirmation.

How it runs. A line's key is the line stripped at both ends with A-Z as a-z.
Keys too short to judge are left out; a document's key counts once.

1. Every task turns the keys of its documents into bit positions of the first
   filter. Its bits follow the corpus (``BITS`` for each line that the corpus
   could hold, counted from its bytes), so it is never held whole: it is cut into
   blocks, and positions travel packed, two to three bytes each, to their block.
   A block is read as a stream into two planes: a bit set before goes into the
   plane of the twice-seen. No key shared by two documents is missed; a key seen
   once is taken for a repeat where its bit meets another key's.
2. The twice-seen positions of all blocks enter the second Bloom filter, of two bits each,
   sized by their count: it grows with the repeated lines only, and never beyond
   ``MAX_BITS`` bits (32 MB), the proven bound of what is broadcast. With more
   repeated lines than that serves, more lines are suspected; none is missed and results stay the same.
3. The documents are read again; lines outside the second filter are done. The
   others leave their task packed, one row for a key and task chunk however
   many documents share it there, so a license line in a third of all documents is a few rows.
   They are grouped by the key's text itself (exact): number of documents and the largest id.
4. Keys in at least ``min_docs`` documents go back, by their packed documents, to
   the documents that lose them; each is joined to its decisions and cut.

Cases. A null or empty text is one empty line. A null ``doc_id`` sorts before
every id. Each row is a document; rows that share an id are counted as several,
and the largest id keeps a line in all its rows, so repeated rows of one
document lose nothing by each other and get equal results. Texts of any length are read whole. An empty table
gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import BYTES, LOWER, Texts, id_key, mix64, pack_u32, rows_of, sliced, text_bytes, unpack_u32
from ordermart.session import cut_lineage, discard_cut

MIN_CHARS, MIN_DOCS = 40, 5
#: Bits of the first filter for each line the corpus could hold, and of the second for each repeated one.
BITS, TWICE_BITS = 8, 16
#: Bits of the second filter at most: 32 MB, what is broadcast at most.
MAX_BITS = 2**28
#: The first filter's blocks: 2**22 bits each, at most 2**16 blocks (then larger ones).
BLOCK, MAX_BLOCKS = 22, 16
#: Line hashes a task gathers before it sends their positions; documents' bytes of a chunk of suspects.
FLUSH, CHUNK_BYTES = 4_000_000, 8_000_000
_SPACE = b" \t\n\x0b\x0c\r"
_CAPITALS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ENTRY = np.dtype([("id", "<i8"), ("print", "<i8"), ("line", "<i4")])


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).translate(_CAPITALS)


def _lines(t: Texts, min_chars: int):
    """Keys of at least ``min_chars`` code points, each once a text: (text, line number, start, end, hash)."""
    breaks = np.flatnonzero(t.data == 10)
    starts = np.sort(np.concatenate([t.offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, t.offsets[1:]]))
    doc = np.repeat(np.arange(len(t.offsets) - 1), np.searchsorted(breaks, t.offsets[1:]) - np.searchsorted(breaks, t.offsets[:-1]) + 1)
    number = np.arange(len(doc)) - np.searchsorted(doc, doc)
    solid = np.flatnonzero((t.data != 32) & ((t.data < 9) | (t.data > 13)))
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = first < last
    doc, number, starts, ends = doc[some], number[some], solid[first[some]], solid[last[some] - 1] + 1
    chars = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
    long = chars[ends] - chars[starts] >= min_chars
    doc, number, starts, ends = doc[long], number[long], starts[long], ends[long]
    h = t.hashes(starts, ends, LOWER)
    order = np.lexsort((number, h, doc))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    at = np.sort(order[new])
    return doc[at], number[at], starts[at], ends[at], h[at]


def _pack(blocks: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(block, n, packed values) of values sorted within sorted blocks."""
    heads = np.append(0, np.flatnonzero(np.diff(blocks)) + 1) if len(blocks) else np.empty(0, np.int64)
    ends = np.append(heads[1:], len(blocks)).astype(np.int64)
    for i in range(0, len(heads), 256):
        spans = list(zip(heads[i:i + 256].tolist(), ends[i:i + 256].tolist()))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(blocks[a]) for a, _ in spans], pa.int32()), pa.array([b - a for a, b in spans], pa.int32()),
            pa.array([pack_u32(np.diff(values[a:b], prepend=0)) for a, b in spans], pa.binary())], ["block", "n", "packed"])


_PACKED = "block int, n int, packed binary"


def _unpack(n: int, blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_u32(blob, n), dtype=np.int64)


def _positions(min_chars: int, bits: int, block: int):
    """Map side of the first filter: positions of all keys, a position met again in the task twice."""

    def send(found: list) -> Iterator[pa.RecordBatch]:
        p = np.sort(np.concatenate(found) >> np.uint64(64 - bits))
        third = np.zeros(len(p), bool)
        third[2:] = p[2:] == p[:-2]
        p = p[~third]
        return _pack((p >> np.uint64(block)).astype(np.int64), (p & np.uint64(2**block - 1)).astype(np.int64))

    def positions(batches):
        found, n = [], 0
        for batch in sliced(batches):
            found.append(_lines(Texts(batch.column("text").to_pylist()), min_chars)[4])
            n += len(found[-1])
            if n >= FLUSH:
                yield from send(found)
                found, n = [], 0
        if n:
            yield from send(found)

    return positions


def _planes(block: int, twice: bool):
    """One block after the other, from sorted rows: the positions set twice (packed), or the bits of all those set."""

    def done(at, plane):
        if twice:
            p = np.flatnonzero(plane)
            return _pack(np.full(len(p), at), p)
        bits = np.packbits(plane, bitorder="little").tobytes()
        return [pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([len(bits)], pa.int32()),
                                            pa.array([bits], pa.binary())], ["block", "n", "packed"])]

    def planes(batches):
        at = once = again = None
        for b, n, blob in rows_of(batches, "block", "n", "packed"):
            if b != at:
                if at is not None:
                    yield from done(at, again)
                at, once, again = b, np.zeros(2**block, bool), np.zeros(2**block, bool)
            p = _unpack(n, blob)
            if twice:
                again[p[once[p]]] = True
                again[p[1:][p[1:] == p[:-1]]] = True
                once[p] = True
            else:
                again[p] = True
        if at is not None:
            yield from done(at, again)

    return planes


def _second_bits(p: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of a first-filter position in the second filter."""
    h = mix64(p.astype(np.uint64) * BYTES[1] + BYTES[2])
    return np.stack([h >> np.uint64(64 - bits), (h >> np.uint64(8)) & np.uint64(2**bits - 1)])


def _second_positions(first_block: int, bits: int, block: int):
    def positions(batches):
        for b, n, blob in rows_of(batches, "block", "n", "packed"):
            p = np.unique(_second_bits((np.int64(b) << first_block) + _unpack(n, blob), bits))
            yield from _pack((p >> np.uint64(block)).astype(np.int64), (p & np.uint64(2**block - 1)).astype(np.int64))

    return positions


def _by_block(rows: DataFrame, blocks: int, fold) -> DataFrame:
    return rows.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(fold, _PACKED)


class TwiceSeen:
    """The second filter with the first one's width: which hashes may belong to two documents or more."""

    def __init__(self, first_bits: int, bits: int, plane: np.ndarray):
        self.first_bits, self.bits, self.plane = first_bits, bits, plane

    def __call__(self, h: np.ndarray) -> np.ndarray:
        a, b = _second_bits(h >> np.uint64(64 - self.first_bits), self.bits)
        return ((self.plane[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8)) &
                (self.plane[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def twice_seen(docs: DataFrame, min_chars: int, bits: int = BITS, max_bits: int = MAX_BITS) -> TwiceSeen:
    """Both filters over all documents (text binary); the second comes back, ``max_bits`` / 8 bytes at most."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    first = max(16, int(total // (min_chars + 1) * bits).bit_length())
    block = max(min(first, BLOCK), first - MAX_BLOCKS)
    sent = docs.select("text").mapInArrow(_positions(min_chars, first, block), _PACKED)
    again = cut_lineage(_by_block(sent, 2**(first - block), _planes(block, True)))
    n = again.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    second = min(max(16, int(n * TWICE_BITS).bit_length()), max_bits.bit_length() - 1)
    slice_bits = min(second, BLOCK)
    packed = _by_block(again.mapInArrow(_second_positions(block, second, slice_bits), _PACKED),
                       2**(second - slice_bits), _planes(slice_bits, False))
    plane = np.zeros(2**second // 8, np.uint8)
    width = 2**slice_bits // 8
    for b, _, bits_of in packed.collect():  # max_bits / 8 bytes at most
        plane[b * width:(b + 1) * width] = np.frombuffer(bytes(bits_of), np.uint8)
    discard_cut(again)
    return TwiceSeen(first, second, plane)


def _suspects(min_chars: int, filter_):
    """Suspected keys of a chunk of documents: (key, n documents, largest id, packed documents)."""

    def send(chunk: dict) -> Iterator[pa.RecordBatch]:
        keys = list(chunk)
        for i in range(0, len(keys), 2000):
            part = keys[i:i + 2000]
            entries = [np.array(chunk[k], _ENTRY) for k in part]
            yield pa.RecordBatch.from_arrays([
                pa.array(part, pa.binary()), pa.array([len(e) for e in entries], pa.int64()),
                pa.array([int(e["id"].max()) for e in entries], pa.int64()),
                pa.array([e.tobytes() for e in entries], pa.binary())], ["key", "n", "top", "entries"])

    def suspects(batches):
        seen, chunk, n = filter_.value, {}, 0
        for batch in sliced(batches):
            ids, prints, texts = (batch.column(c).to_pylist() for c in ("id_key", "print", "text"))
            t = Texts(texts)
            doc, number, starts, ends, h = _lines(t, min_chars)
            hit = np.flatnonzero(seen(h)) if len(h) else []
            for d, i, a, b in zip(doc[hit].tolist(), number[hit].tolist(), starts[hit].tolist(), ends[hit].tolist()):
                key = t.data[a:b].tobytes().translate(_CAPITALS)
                chunk.setdefault(key, []).append((ids[d], prints[d], i))
            n += len(t.data)
            if n >= CHUNK_BYTES:
                yield from send(chunk)
                chunk, n = {}, 0
        if chunk:
            yield from send(chunk)

    return suspects


def _losses(batches):
    """Packed documents of confirmed keys -> the lines that go, by document; the largest id keeps its own."""
    for top, blob in rows_of(batches, "keeper", "entries"):
        e = np.frombuffer(blob, _ENTRY)
        e = e[e["id"] != top]
        if len(e):
            yield pa.RecordBatch.from_arrays([pa.array(e[c].copy()) for c in ("id", "print", "line")], ["id_key", "print", "line"])


def common_lines(docs: DataFrame, seen, min_chars: int, min_docs: int) -> DataFrame:
    """(id_key, print, lines): line numbers whose key a document loses, the first
    line of each key. ``docs``: id_key, print, text binary."""
    rows = cut_lineage(docs.mapInArrow(_suspects(min_chars, seen), "key binary, n long, top long, entries binary"))
    exact = (rows.groupBy("key").agg(F.sum("n").alias("n_docs"), F.max("top").alias("keeper"))
             .where(F.col("n_docs") >= min_docs).select("key", "keeper"))
    lost = rows.select("key", "entries").join(exact, "key").select("keeper", "entries").mapInArrow(
        _losses, "id_key long, print long, line int")
    # rows repeated under one id and text carry the same lines: a set
    out = cut_lineage(lost.groupBy("id_key", "print").agg(F.collect_set("line").alias("lines")))
    discard_cut(rows)
    return out


def _cut(batches):
    for batch in batches:
        out = []
        for doc_id, text, lost in rows_of([batch], "doc_id", "text", "lines"):
            lines = text.split(b"\n")
            if lost:
                keys = [line_key(x) for x in lines]
                gone = {keys[i] for i in lost}
                kept = [x for x, k in zip(lines, keys) if k not in gone]
            else:
                kept = lines
            out.append((doc_id, len(lines), len(lines) - len(kept), b"\n".join(kept)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "n_lines", "n_dropped", "kept"])


def drop_common_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      bits: int = BITS, max_bits: int = MAX_BITS) -> DataFrame:
    """Every document without the lines whose key of at least ``min_chars`` code points
    is in at least ``min_docs`` documents, except in the largest id that
    holds it: (doc_id, n_lines before, n_dropped, kept_text)."""
    spark = documents.sparkSession
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), id_key(F.col("doc_id")).alias("id_key"),
        text_bytes(F.col("text")).alias("text")).withColumn("print", F.xxhash64("text"))
    seen = spark.sparkContext.broadcast(twice_seen(docs, min_chars, bits, max_bits))
    lost = common_lines(docs.select("id_key", "print", "text"), seen, min_chars, min_docs)
    return docs.join(lost, ["id_key", "print"], "left").select("doc_id", "text", "lines").mapInArrow(
        _cut, "doc_id long, n_lines long, n_dropped long, kept binary"
    ).withColumn("kept_text", F.col("kept").cast("string")).drop("kept")
