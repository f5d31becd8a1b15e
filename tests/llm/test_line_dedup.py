"""Line dedup against a brute-force version; the Bloom filters miss no repeat."""

import hashlib
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import line_dedup as ld
from ordermart.llm.common import corpus_session


def brute(rows, min_chars, min_docs):
    split = [(-2**63 if d is None else d, d, (t or "").split("\n")) for d, t in rows]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders = defaultdict(list)
    for order, _, lines in split:
        for k in {key(x) for x in lines}:
            holders[k].append(order)
    gone = {k: max(o) for k, o in holders.items() if len(k) >= min_chars and len(o) >= min_docs}
    out = []
    for order, d, lines in split:
        kept = [x for x in lines if gone.get(key(x), order) == order]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, min_chars, min_docs, **kw):
    corpus_session(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit("x")).withColumn(
        "key", F.lit(1)).repartition(5)
    out = ld.drop_common_lines(df, min_chars, min_docs, **kw).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


def sample(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("Éa bB çÇ Dd 漢字 zz".split()) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    rows = []
    for d in range(80):
        lines = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "\r", " \x0b"])
                 for x in rng.choices(pool, k=rng.randrange(0, 9))]
        rows.append((d * 7 % 83, "\n".join(lines)))
    return rows + [(None, "\n".join(pool[:20])), (3, pool[0] + "\n" + pool[1]), (3, pool[0] + "\n" + pool[1]), (500, None),
                   (501, ""), (502, "\n\n"), (503, ("long line " * 30000) + "\n" + pool[2]), (504, "\n".join([pool[3]] * 2000))]


def test_matches_brute_force(spark):
    for seed, (chars, docs) in enumerate([(8, 3), (1, 5), (10, 2)]):
        rows = sample(seed)
        want = brute(rows, chars, docs)
        assert run(spark, rows, chars, docs) == want and any(r[2] for r in want)


def test_small_filters_and_chunks_suspect_more_and_change_nothing(spark, monkeypatch):
    rows = sample(9)
    monkeypatch.setattr(ld, "CHUNK_BYTES", 300)
    monkeypatch.setattr(ld, "FLUSH", 20)
    monkeypatch.setattr(ld, "BLOCK", 12)
    assert run(spark, rows, 8, 3, max_bits=2**16) == brute(rows, 8, 3)


def test_saturated_filter_misses_nothing(spark, monkeypatch):
    rows = sample(4)
    monkeypatch.setattr(ld, "twice_seen", lambda *_: ld.TwiceSeen(16, 16, np.full(2**13, 255, np.uint8)))
    assert run(spark, rows, 8, 3) == brute(rows, 8, 3)


def test_only_repeats_are_suspected(spark):
    """4,000 lines of one document each and 40 shared ones: nearly nothing but the shared ones passes the filters."""
    corpus_session(spark)
    rows = [(d, "\n".join([f"a line of document {d} numbered {i} and nowhere else at all" for i in range(40)]
                          + [f"the shared line {d % 40} that several documents hold word by word"])) for d in range(100)]
    docs = spark.createDataFrame(rows, "id_key long, text string").select(
        "id_key", F.col("text").cast("binary").alias("text")).withColumn("print", F.xxhash64("text"))
    seen = spark.sparkContext.broadcast(ld.twice_seen(docs, 40))
    found = docs.mapInArrow(ld._suspects(40, seen), "key binary, n long, top long, entries binary").groupBy("key").agg(
        F.sum("n").alias("n"))
    counts = {bytes(r["key"]): r["n"] for r in found.collect()}
    shared = {f"the shared line {i} that several documents hold word by word".encode() for i in range(40)}
    assert shared <= set(counts) and len(counts) < 40 + 0.1 * 4000
    assert all(counts[k] in (2, 3) for k in shared)


def test_one_line_in_every_document_is_few_rows(spark):
    corpus_session(spark)
    rows = [(d, "the one license line that every single document repeats") for d in range(5000)]
    docs = spark.createDataFrame(rows, "id_key long, text string").select(
        "id_key", F.col("text").cast("binary").alias("text")).withColumn("print", F.xxhash64("text")).coalesce(2)
    seen = spark.sparkContext.broadcast(ld.twice_seen(docs, 40))
    assert docs.mapInArrow(ld._suspects(40, seen), "key binary, n long, top long, entries binary").count() <= 2
    got = run(spark, rows, 40, 5)
    assert [r[0] for r in got if not r[2]] == [4999] and len(got) == 5000


def test_empty_table(spark):
    assert run(spark, [], 40, 5) == []
