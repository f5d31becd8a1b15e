"""Substring dedup against a brute-force version."""

import hashlib
import random

from pyspark.sql import functions as F

from ordermart.llm import substring_dedup as sd
from ordermart.llm.common import corpus_session


def brute(rows, size):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha256)."""
    order = lambda d: -2**63 if d is None else d
    split = [(order(d), (t or "").encode().split(), d) for d, t in rows]
    first = {}
    for d, w, _ in split:
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, w, doc_id in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (d, i):
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, size, **kw):
    corpus_session(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("starts", F.lit("x")).withColumn(
        "print", F.lit(1)).repartition(5)
    out = sd.remove_repeats(df, size, **kw).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_matches_brute_force_on_random_overlaps(spark):
    rng = random.Random(5)
    base = [rng.choice("ab cd ef gh é ß 漢".split()) for _ in range(400)]
    rows = []
    for d in range(60):
        a = rng.randrange(380)
        words = base[a:a + rng.randrange(1, 40)] + [rng.choice("xyz") for _ in range(rng.randrange(12))]
        rows.append((d * 7 % 61, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(None, " ".join(base[:30])), (3, " ".join(base[2:40])), (3, " ".join(base[2:40])), (500, None), (501, ""),
             (502, "a" * 5000), (503, " ".join(base[:30])), (504, " ".join(["same"] * 50))]
    for size in (4, 6):
        assert run(spark, rows, size) == brute(rows, size)
    assert run(spark, rows, 5, bucket_windows=50) == brute(rows, 5)  # many buckets


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rows = [(d, " ".join(f"w{(d * 3 + i) % 50}" for i in range(30))) for d in range(40)]
    monkeypatch.setattr(sd, "CHUNK_BYTES", 200)
    assert run(spark, rows, 5) == brute(rows, 5)


def test_empty_table(spark):
    assert run(spark, [], 20) == []


def test_registered_query_on_the_small_tables(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in e.queries()["op1_substring_dedup"](spark, sf).collect()), key=str)
    assert got == brute(rows, 20) and any(r[2] for r in got)
