"""Helpers shared by the corpus operators: words, hashes, tables, packing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.session import prepare_session

#: A row without an id sorts before every id and is keyed by this value.
NULL_ID = -(2**63)
_ZSTD, _UNZSTD = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
#: Rows per Arrow batch: whole texts travel in them, so batches are kept small.
ARROW_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus_session(spark: SparkSession) -> None:
    """Settings the corpus operators rely on (UTC, a shared checkpoint
    folder, small Arrow batches since a row holds a whole text)."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def id_key(col: Column) -> Column:
    return F.coalesce(col.cast("long"), F.lit(NULL_ID))


def text_bytes(col: Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Random values of the 256 bytes, and the same with A-Z as a-z.
BYTES = mix64(np.arange(1, 257, dtype=np.uint64))
LOWER = BYTES.copy()
LOWER[65:91] = BYTES[97:123]
_BASE, _BLOCK = 0x9E3779B97F4A7C15, 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = powers(_BASE, _BLOCK), powers(pow(_BASE, -1, 2**64), _BLOCK + 1)  # an empty span may start at the end


class Texts:
    """A batch of texts as one array of bytes, worked on without a Python object per word."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.cumsum([0, *map(len, texts)])

    def edges(self, inside: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of bytes ``inside``, within texts; ``cut``: bytes that also begin a run."""
        first = np.zeros(len(inside) + 1, bool)
        first[self.offsets] = True
        begin = first[:-1].copy()
        begin[1:] |= ~inside[:-1]
        if cut is not None:
            begin |= cut
        stop = np.append(begin[1:], True) & inside
        stop[:-1] |= inside[:-1] & ~inside[1:]
        return np.flatnonzero(begin & inside), np.flatnonzero(stop) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.edges(~_SPACE[self.data])

    def owner(self, starts: np.ndarray) -> np.ndarray:
        """The text of each start."""
        return np.searchsorted(self.offsets, starts, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
        """64-bit hash of each span (ordered, not overlapping): sum of table[byte] * base^i from its start."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            lo = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, side="right")))
            n = ends[j - 1] - lo
            up, down = (_UP[:n], _DOWN) if n <= _BLOCK else (powers(_BASE, n), _DOWN)  # one very long span
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum(table[self.data[lo:lo + n]] * up, out=sums[1:])
            out[i:j] = (sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * down[starts[i:j] - lo]
            i = j
        return mix64(out)


def pack_u32(values: np.ndarray) -> bytes:
    """uint32 values as byte planes under zstd: small differences take about a byte."""
    planes = np.ascontiguousarray(values, dtype=np.uint32).view(np.uint8).reshape(-1, 4).T
    return _ZSTD.compress(np.ascontiguousarray(planes).tobytes())


def unpack_u32(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_UNZSTD.decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view(np.uint32).ravel()


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as plain tuples of the named columns."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def sliced(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (one row at
    least), so the memory of per-batch arrays does not depend on text lengths."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def compress_texts(docs: DataFrame, text: str, out: str = "ztext") -> DataFrame:
    """Replace a binary text column by its zstd form, so a text that has to
    cross a shuffle takes about a third of its bytes."""
    keep = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"{out} binary"])

    def packed(batches):
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            blobs = pa.array([z.compress(t) for t in b.column(text).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), blobs], [*(f.name for f in keep), out])

    return docs.mapInArrow(packed, schema)


def decompress(blob: bytes) -> bytes:
    return _UNZSTD.decompress(blob)
