"""Decontamination against exact all-pairs similarity, and the Hamming index against brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as e
from ordermart.llm import decontaminate as dc
from ordermart.llm.common import corpus_session

VOCABULARY = [a + b for a in "ba ce di fo gu lo mi na re su".split() for b in "nd rt sk lp mo va ze ki tu ".split(" ")]


def words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    probes = rng.integers(0, 2**64, 40, dtype=np.uint64)
    near = []
    for p in probes:
        for r in range(0, 14):
            flips = rng.choice(64, r, replace=False)
            near.append(p ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64)) if r else p)
    prints = np.concatenate([np.array(near, np.uint64), rng.integers(0, 2**64, 3000, dtype=np.uint64)])
    index = dc.SizeIndex(8, probes, np.arange(40), np.zeros(40, np.int64))
    want = {(i, j) for i, p in enumerate(prints) for j, q in enumerate(probes) if int(p ^ q).bit_count() <= dc.RADIUS}
    assert set(zip(*(x.tolist() for x in index.within(prints)))) == want and len(want) >= 40 * 9


def test_window_fingerprints_equal_direct_sums():
    rng = random.Random(2)
    w = dc.Words([" ".join(words(rng, 70)).encode()])
    v = w.weights().astype(int)
    for size, prints in w.simhashes([1, 2, 3, 4, 6, 12, 32, 48]):
        want = [np.packbits(v[i:i + size].sum(axis=0) > 0).view(np.uint64)[0] for i in range(70 - size + 1)]
        assert prints.tolist() == want


def test_size_classes():
    assert [dc.size_class(n) for n in (1, 2, 3, 4, 5, 10, 20, 60, 100, 10**6)] == [1, 1, 2, 3, 4, 8, 16, 48, 64, 786432]


def test_matches_equal_brute_force(spark, monkeypatch):
    corpus_session(spark)
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, rng.randrange(15, 70)))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "-- !!"), (103, items[0][1]), (104, "one two three"), (None, "null id item here now")]
    docs, planted = [], set()
    for d in range(120):
        body = words(rng, rng.randrange(0, 200))
        if d % 3 == 0:
            i, text = items[rng.randrange(30)]
            w = text.split()
            if d % 2:  # an edit at either end
                w = w[1:] if d % 4 == 1 else w[:-1] + ["changed"]
            at = rng.randrange(len(body) + 1)
            body[at:at] = [x.upper() if d % 5 == 0 else x + rng.choice(["", ",", "."]) for x in w]
            planted.add((d, i))
        docs.append((d, rng.choice([" ", "\n", "  "]).join(body)))
    docs += [(500, None), (501, ""), (502, "one, two THREE"), (503, "one two four"), (None, items[1][1]), (3, docs[3][1]),
             (504, " ".join(words(rng, 30_000)) + " " + items[2][1])]
    want = set()
    for d, t in docs:
        w = dc.Words([(t or "").encode()])
        for i, text in items:
            x = dc.Words([(text or "").encode()])
            n, a = len(x), dc.shingles(x.hashes, x.sizes)
            if n and any(dc.weighted_jaccard(a, dc.shingles(w.hashes[p:p + n], w.sizes[p:p + n])) >= dc.SIMILARITY
                         for p in (range(max(1, len(w) - n + 1)) if d != 504 or i == 2 else ())):
                want.add((d, i))
    assert {(d, i) for d, i in planted} <= want and {(502, 104), (None, 1), (504, 2)} <= want and (503, 104) not in want
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("matches", F.lit("x")).withColumn("row", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (2000, 7):  # one pass, several passes
        monkeypatch.setattr(dc, "PASS_ITEMS", block)
        got = dc.contaminated(df, bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert all(r.similarity >= dc.SIMILARITY for r in got)
    clean = dc.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert dc.contaminated(df, bench.where("false")).count() == 0 and dc.contaminated(df.where("false"), bench).count() == 0


def test_registered_query_finds_exact_passages(spark):
    sf = "/root/testdata/sf0.01"
    flat = lambda t: " ".join((t or "").lower().split())
    items = [(r.item_id, flat(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, x in items if x in flat(r.text)}
    got = {(r.doc_id, r.item_id) for r in e.queries()["op9_decontamination"](spark, sf).collect()}
    assert want and want <= got


def best_of_all_spans(item, text):
    """Weighted Jaccard of the best span, over all starts and ends, from the words themselves."""
    def grams(w):
        return [tuple(w[i:i + dc.SHINGLE]) for i in range(len(w) - dc.SHINGLE + 1)]

    def weight(g):
        return sum(map(len, g))

    a, best = Counter(grams(item)), 0.0
    total = sum(weight(g) * n for g, n in a.items())
    for s in range(len(text)):
        seen, both, own = Counter(), 0, 0
        for g in grams(text[s:]):
            seen[g] += 1
            own += weight(g)
            both += weight(g) if seen[g] <= a[g] else 0
            best = max(best, both / (total + own - both))
    return best


def test_passages_that_lost_or_gained_words():
    rng = random.Random(11)
    pool = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 10))) for _ in range(400)]
    found, wanted = Counter(), Counter()
    for n in (20, 40, 50, 90):
        for edit in ("drop", "insert"):
            for at in (0, 1, 2, n // 4, n // 2, n // 2 + 3, n - 3, n - 2, n - 1) * 3:
                item = rng.choices(pool, k=n)
                if at % 2:
                    item[n // 2:n // 2 + 6] = item[:6]  # a repeated shingle
                passage = item[:at] + (item[at + 1:] if edit == "drop" else ["gained", *item[at:]])
                text = rng.choices(pool, k=40) + passage + rng.choices(pool, k=40)
                best = best_of_all_spans(item, text)
                got = dc.find([b"other text", " ".join(text).encode()], dc.build_index([(5, " ".join(item).encode())]))[1]
                assert best >= dc.SIMILARITY or not got
                if best >= dc.SIMILARITY:
                    wanted[edit, n] += 1
                    found[edit, n] += len(got)
                for m in got:
                    assert abs(m["similarity"] - best) < 2e-6
                    span = text[m["start"]:m["start"] + m["n_words"]]
                    assert abs(best_of_all_spans(item, span) - best) < 1e-9
    assert all(n >= 9 for n in wanted.values()) and len(wanted) == 8
    assert sum(found.values()) >= 0.97 * sum(wanted.values())
    assert all(found[k] >= 0.9 * wanted[k] for k in wanted), (found, wanted)


def test_passes_hold_one_index_at_a_time(spark, monkeypatch):
    """Many passes: each index is sent for its own job and taken away after it; the result is that of one pass."""
    corpus_session(spark)
    rng = random.Random(21)
    items = [(i, " ".join(words(rng, 20))) for i in range(40)]
    docs = [(d, " ".join(words(rng, 30) + items[d % 40][1].split() + items[(d * 7) % 40][1].split())) for d in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("row", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(tuple(r) for r in dc.contaminated(df, bench).collect())
    live, most = set(), []
    real = spark.sparkContext.broadcast

    def broadcast(value):
        b = real(value)
        live.add(b)
        most.append(len(live))
        destroy = b.destroy
        monkeypatch.setattr(b, "destroy", lambda: (live.discard(b), destroy()))
        return b

    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    monkeypatch.setattr(dc, "PASS_ITEMS", 3)
    monkeypatch.setattr(dc, "_MERGE", 4)
    kept = dc.keep_clean(df, bench)
    assert sorted(tuple(r) for r in dc.contaminated(df, bench).collect()) == whole and len(whole) >= 90
    assert max(most) == 1 and len(most) >= 28 and not live
    assert kept.columns == df.columns and kept.count() == 0


def recall(sizes, trials, seed=1):
    """Share of passages with one word dropped, inserted or substituted that are found, per item length."""
    rng = random.Random(seed)
    out = {}
    for n in sizes:
        items = [(i, " ".join(words(rng, n)).encode()) for i in range(trials)]
        index = dc.build_index(items)
        hit = 0
        for i, (_, text) in enumerate(items):
            w, at = text.decode().split(), rng.randrange(n)
            w[at:at + (i % 3 != 1)] = [] if i % 3 == 0 else ["changed"]
            found = dc.find([" ".join(words(rng, 40) + w + words(rng, 40)).encode()], index)[0]
            hit += any(m["item_id"] == i for m in found)
        out[n] = hit / trials
    return out


def test_long_items_are_found_whole():
    """Items longer than any window that 16-bit sums could hold."""
    assert min(recall((500, 2000, 5000, 12_000), 9).values()) == 1
    rng = random.Random(3)
    item = words(rng, 9000)
    half = dc.find([" ".join(item[:4500] + words(rng, 4500)).encode()], dc.build_index([(1, " ".join(item).encode())]))[0]
    assert half == []  # half of it is not it
