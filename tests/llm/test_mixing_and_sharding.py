"""Poisson mixing against its inversion in Python, sharding against a brute-force minimax partition."""

import collections
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ordermart.llm import mixing, sharding
from ordermart.llm.common import corpus_session

SCHEMA = "doc_id long, text string, lang string, source string"


def h(digits, *parts):
    return int(hashlib.md5(":".join([str(mixing.SEED), *map(str, parts)]).encode()).hexdigest()[:digits], 16)


def poisson(rate, u):
    k, log, cdf = 0, -rate, math.exp(-rate)
    while cdf <= u:
        k += 1
        log += math.log(rate / k)
        cdf += math.exp(log)
    return k


def brute_mix(rows, weight=lambda s, n: math.sqrt(n)):
    n = collections.Counter(r[3] for r in rows)
    total = sum(weight(s, c) for s, c in n.items())
    out = []
    for d, text, _, s in rows:
        i = d if d is not None else "t" + hashlib.md5((text or "").encode()).hexdigest()
        rate = weight(s, n[s]) / total * len(rows) / n[s] if total else 0
        copies = poisson(rate, h(13, i) / 16**13) if rate else 0
        out += [(h(15, "order", i, k), d, s, k) for k in range(1, copies + 1)]
    return sorted(out, key=str)


def rows_for_mixing():
    rng = random.Random(3)
    rows = [(i, f"t{i}", "x", rng.choice(["a", "a", "a", "a", "b", None])) for i in range(600)]
    return rows + [(1000, None, None, "a"), (1001, "", "x", "b"), (1002, "long " * 9000, "x", "b"), (None, "n1", "x", "a"),
                   (None, "n2", "x", "a"), (5, "t5", "x", rows[5][3]), (2000, "only", "x", "rare")]


@pytest.mark.parametrize("limit", [10_000, 0])  # broadcast, and the joined way
def test_mixture_equals_inversion(spark, limit, monkeypatch):
    corpus_session(spark)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    rows = rows_for_mixing()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("copy", F.lit("x")).withColumn("s", F.lit(2)).repartition(3)
    out = mixing.mixture(df).collect()
    assert sorted(((r.mix_key, r.doc_id, r.source, r.copy) for r in out), key=str) == brute_mix(rows)
    assert [r.mix_key for r in out] == sorted(r.mix_key for r in out)


def test_target_weights_and_large_rates(spark):
    corpus_session(spark)
    rows = [(i, "t", "x", "a" if i else "b") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    weights = {"a": 1.0, "b": 3.0}
    got = mixing.mix(df, weights, size=4000, keep=["doc_id"]).groupBy("row.doc_id").count().collect()
    by_id = {r["doc_id"]: r["count"] for r in got}
    assert by_id[0] == poisson(3000.0, h(13, 0) / 16**13)  # exp(-3000) is zero in doubles; the count is not
    assert abs(by_id[0] - 3000) < 400 and 800 < sum(v for k, v in by_id.items() if k) < 1200
    only = mixing.mix(df, {"b": 1.0}, keep=["doc_id"]).select("row.doc_id").distinct().collect()
    assert {r[0] for r in only} <= {0}
    assert mixing.mixture(df.where("false")).count() == 0 and mixing.mix(df, {}).count() == 0


def test_replicate_keeps_columns(spark):
    corpus_session(spark)
    df = spark.createDataFrame(rows_for_mixing(), SCHEMA).withColumn("row", F.lit("r")).withColumn("mix_key", F.lit(1))
    out = mixing.replicate(df)
    assert out.columns == df.columns and out.count() == len(brute_mix(rows_for_mixing()))


def minimax(sizes, shards):
    """Smallest largest run of a contiguous partition, by binary search over the plain list."""
    def fits(c):
        n, s = 1, 0
        for v in sizes:
            if v > c:
                return False
            if s + v > c:
                n, s = n + 1, 0
            s += v
        return n <= shards

    low, high = 1, max(1, sum(sizes))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def check_manifest(spark, rows, shards=16):
    corpus_session(spark)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("x")).withColumn("key", F.lit(1)).repartition(4)
    out = sharding.manifest(df, shards).collect()
    text = lambda t: (t or "").encode()
    want = sorted((str(d), len(text(t)) + 1, zlib.crc32(text(t))) for d, t, _, _ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want
    assert {r.law for r in out} <= {"bytes"} and all(0 <= r.shard < shards and r.grown_shard is None for r in out)
    slots, sizes, where = collections.defaultdict(list), collections.Counter(), collections.defaultdict(set)
    by_id = {}
    for d, t, _, _ in rows:
        by_id.setdefault((d, zlib.crc32(text(t))), t)
    for r in out:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        where[by_id[r.doc_id, r.text_crc32] or ""].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in where.values())
    groups = collections.Counter()
    for _, t, _, _ in rows:
        groups[hashlib.sha256(text(t)).hexdigest()] += len(text(t)) + 1
    total, alone = sum(groups.values()), []
    for k, v in sorted(groups.items(), key=lambda x: (-x[1], x[0])):
        if len(alone) < shards - 1 and v * (shards - len(alone)) > total:
            alone.append(v)
            total -= v
            del groups[k]
    best = minimax([v for _, v in sorted(groups.items())], shards - len(alone)) if groups else 0
    assert max(sizes.values(), default=0) == max([best, *alone], default=0)


@pytest.mark.parametrize("seed", range(3))
def test_shards_have_the_smallest_largest(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(sharding, "_FIRST", 1)  # 16 ranges, so they must be opened
    monkeypatch.setattr(sharding, "_STEP", 1)
    monkeypatch.setattr(sharding, "CELL_ROWS", 40)
    rows = [(rng.randrange(400), "é" * rng.randrange(1, 9) + str(rng.randrange([100, 3000, 30][seed])) * rng.randrange(1, 30), "x", "s")
            for _ in range(900)]
    check_manifest(spark, rows)


def test_shards_of_odd_tables(spark):
    hot = [(i, "the same text", "x", "s") for i in range(300)]
    odd = [(None, None, "x", "s"), (None, None, "x", "s"), (7, "", "x", "s"), (8, "y" * 60_000, "x", "s"), (9, "z", None, None), (9, "z", "x", "s")]
    check_manifest(spark, hot + odd + [(i, f"text {i}", "x", "s") for i in range(400)])
    check_manifest(spark, odd)
    check_manifest(spark, hot[:1])
    corpus_session(spark)
    assert sharding.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_place_keeps_rows_and_columns(spark):
    corpus_session(spark)
    rows = [(1, "a", "x", "s"), (1, "a", "y", "t"), (None, "b", "x", "s"), (None, "b", "x", "s"), (3, None, "x", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("k"))
    out = sharding.place(df, 4)
    assert out.columns == [*df.columns, "shard", "slot"]
    got = out.collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(rows, key=str)
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
