"""Key-to-partition index of a versioned table.

Beside the data of each version lies, per partition folder and hash block of its keys, a Bloom
filter (``BITS`` bits a key, ``PROBES`` probes: about one wrong answer in three million, none missed). A merge tests
the keys of its updates against these instead of scanning the key column of the whole table; only the
folders that may hold one of the keys are then read for their keys, and only those that do are rewritten.

The update keys reach the tasks as 64-bit hashes, ``MAX_KEYS`` at most (8 MB); a larger update, which
touches most folders anyway, takes all folders as candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS, BITS, PROBES, MAX_KEYS = 16, 32, 16, 1_000_000
SCHEMA = "part string, block int, n long, bits binary"


def _position(hashes: np.ndarray, probe: int, size: int) -> np.ndarray:
    """Bit of each hash at a probe, in a filter of ``size`` bits (a power of two): a mixed step of a counter."""
    x = hashes.view(np.uint64) + np.uint64((probe + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64(size - 1)


def _filter(hashes: np.ndarray) -> bytes:
    size = max(64, 1 << int(len(hashes) * BITS - 1).bit_length())
    bits = np.zeros(size, bool)
    for i in range(PROBES):
        bits[_position(hashes, i, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    plane = np.frombuffer(bits, np.uint8)
    for i in range(PROBES):
        if not len(hashes):
            return False
        at = _position(hashes, i, 8 * len(plane))
        hashes = hashes[(plane[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return len(hashes) > 0


def _block_of(h):
    return F.pmod(h, F.lit(BLOCKS)).cast("int")


def build(rows: DataFrame, key: str, partition_col: str) -> DataFrame:
    """The index rows of a partitioned frame: one per folder and hash block."""
    part = F.concat(F.lit(f"{partition_col}="), F.coalesce(F.col(partition_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    hashed = rows.select(part.alias("part"), F.xxhash64(F.col(key)).alias("h")).withColumn("block", _block_of(F.col("h")))

    def filters(batches):
        at, found, out = None, [], []

        def flush():
            ready = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.string(), pa.int32(), pa.int64(), pa.binary()))], ["part", "block", "n", "bits"])
            out.clear()
            return ready

        def close():
            h = np.concatenate(found)
            out.append((*at, len(h), _filter(h)))

        for batch in batches:
            part, block, h = batch.column("part").dictionary_encode(), *(
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "h"))
            code = part.indices.to_numpy(zero_copy_only=False).astype(np.int64) * BLOCKS + block
            edges = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(h)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                name = part.dictionary[int(code[a]) // BLOCKS].as_py(), int(block[a])
                if name != at:
                    if found:
                        close()
                    at, found = name, []
                found.append(h[a:b])
            if sum(len(r[3]) for r in out) > 8 << 20:
                yield flush()
        if found:
            close()
        if out:
            yield flush()

    return hashed.repartition("part", "block").sortWithinPartitions("part", "block").mapInArrow(filters, SCHEMA)


def candidates(index: DataFrame, live: dict[str, str], keys: DataFrame, key: str, max_keys: int = MAX_KEYS) -> list[str]:
    """The folders of ``live`` (folder -> tag) that may hold one of ``keys``. ``index``:
    rows of :func:`build` with their ``version`` tag; folders without index rows are candidates."""
    if keys.count() > max_keys:
        return list(live)
    hashes = np.array([r[0] for r in keys.select(F.xxhash64(F.col(key))).distinct().collect()], np.int64)  # max_keys at most
    hashes = hashes[np.argsort(hashes % BLOCKS, kind="stable")]
    edges = np.searchsorted(hashes % BLOCKS, np.arange(BLOCKS + 1))
    sent = keys.sparkSession.sparkContext.broadcast((live, hashes, edges))

    def probe(batches):
        live, hashes, edges = sent.value
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("version", "part", "block", "bits")))
            hits = sorted({p for v, p, k, b in rows if live.get(p) == v and _may_hold(b, hashes[edges[k]:edges[k + 1]])})
            seen = sorted({p for v, p in zip(batch.column("version").to_pylist(), batch.column("part").to_pylist()) if live.get(p) == v})
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), pa.array(np.isin(seen, hits))], ["part", "hit"])

    found = index.select("version", "part", "block", "bits").mapInArrow(probe, "part string, hit boolean").groupBy("part").agg(
        F.max("hit").alias("hit")).collect()  # one row a folder
    known = {r["part"]: r["hit"] for r in found}
    sent.unpersist()
    return [p for p in live if known.get(p, True)]
