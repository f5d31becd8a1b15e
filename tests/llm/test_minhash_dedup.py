"""MinHash near-dedup against exact all-pairs similarity."""

import random

import pytest
from pyspark.sql import functions as F

from ordermart.llm import minhash_dedup as md
from ordermart.llm.common import corpus_session

SCHEMA = "doc_id long, text string"


def shingles(text, size):
    w = ("".join(c.lower() if c.isascii() else c for c in text or "")).encode().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[root(i)] if sets[i] and d is not None else d
        out.append((d, len(sets[i]), c, d is None or c == d))
    return sorted(out, key=str)


def run(spark, rows, size, percent):
    corpus_session(spark)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("x")).withColumn("cls", F.lit(1)).repartition(4)
    out = md.near_duplicates(df, size, percent).select("doc_id", "n_shingles", "component_id", "kept")
    return sorted((tuple(r) for r in out.collect()), key=str)


def near_copies(seed, groups=6, each=14):
    """Chains of edits: copies drift, so some pairs of a group are linked and some are not."""
    rng, rows = random.Random(seed), []
    line = " ".join(f"common{i}" for i in range(12))
    for _ in range(groups):
        words = [rng.choice("aa Bb cc dd ee ff gg hh ii jj kk Éé ll mm".split()) + str(rng.randrange(50))
                 for _ in range(rng.randrange(20, 120))]
        for _ in range(each):
            rows.append((rng.randrange(10**6), rng.choice([line + "\n", ""]) + " ".join(words)))
            if rng.random() < 0.7:
                words = list(words)
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent, monkeypatch):
    monkeypatch.setattr(md, "BLOCK", 4)  # several blocks in a list
    rows = near_copies(size)
    a = rows[0][1]
    rows += [(1, a), (1, a), (2, a.upper()), (None, a), (3, None), (4, ""), (5, " \n"), (6, "one"), (7, "ONE"),
             (8, "one two"), (9, "K two"), (10, "k two"), (11, "long " * 4000)]
    assert run(spark, rows, size, percent) == brute(rows, size, percent)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_lists_posted_again_equal_brute_force(spark, size, percent, monkeypatch):
    monkeypatch.setattr(md, "LONG", 5)
    monkeypatch.setattr(md, "BLOCK", 4)
    rows = near_copies(size + 10, groups=4)
    assert run(spark, rows, size, percent) == brute(rows, size, percent)


def template_pages(n, template, own):
    line = " ".join(f"t{i}" for i in range(template))
    return [(i, line + " " + " ".join(f"w{i}x{j}" for j in range(own))) for i in range(n)]


def test_pages_of_one_template_do_not_meet_again(spark):
    """Pages that share half of their text are one long list; with further coordinates next to none meet, edited copies do."""
    corpus_session(spark)
    rows = template_pages(3000, 62, 60)
    rows += [(10_000 + i, rows[i][1].replace(f"w{i}x7", "changed")) for i in range(50)]
    texts = spark.createDataFrame(rows, SCHEMA).select(
        F.col("doc_id").cast("string").cast("binary").alias("cls"), F.col("text").cast("binary").alias("text"))
    texts = md.compress_texts(texts, "text").cache()
    members = texts.select("cls", F.lit(1).cast("long").alias("key"), F.col("cls").alias("comp"))
    again = md.posted_again(members, texts, 3, 85)
    met = {bytes(r["cls"]) for r in again.select("cls").distinct().collect()}
    assert met >= {str(i).encode() for i in range(50)} | {str(10_000 + i).encode() for i in range(50)}
    assert len(met) < 100 + 0.05 * 3000


def test_many_template_pages_have_no_links(spark):
    rows = template_pages(5000, 60, 58) + [(9_999, "an unrelated text of several words"), (20_000, template_pages(3, 60, 58)[2][1] + " more")]
    out = run(spark, rows, 3, 85)
    assert [r[:1] + r[2:] for r in out if not r[3]] == [(20_000, 2, False)] and len(out) == len(rows)


def test_empty_table(spark):
    assert run(spark, [], 3, 85) == []


def test_match_threshold_bounds_the_miss_rate():
    from math import comb

    for percent in (80, 85, 95):
        t = md.match_threshold(percent)
        p = percent / 100
        assert sum(comb(32, k) * p**k * (1 - p) ** (32 - k) for k in range(t)) <= md.MISS


def test_keep_one_per_group_keeps_columns_and_unique_rows(spark):
    corpus_session(spark)
    a = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(4, a, "x"), (2, a, "y"), (2, a, "y"), (9, "other words entirely here now", "z"), (None, a, "n"), (11, None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = md.keep_one_per_group(df)
    assert out.columns == df.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(2, a, "y"), (9, "other words entirely here now", "z"), (None, a, "n"), (11, None, "q")], key=str)


def test_registered_query_on_the_small_tables(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = e.queries()["op7_minhash_near_dedup"](spark, sf).select("doc_id", "n_shingles", "component_id", "kept")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute(rows, 3, 85) and not all(r[3] for r in got)


def test_members_of_several_lists_meet_in_one(spark):
    """Four copies that share three lists, and a fifth in the last only: a pair is compared in its list of least number."""
    import pyarrow as pa

    def member(i, lists):
        return {"cls": bytes([i]), "comp": bytes([i]), "n_shingles": 9, "sig": list(range(md.COORDINATES)), "lists": lists}

    copies = [member(i, [-3, -2, -1]) for i in range(4)]
    blocks = [{"key": k, "q": 0, "d": 0, "query": m, "data": m} for k, m in (
        (-3, copies), (-2, copies), (-1, [*copies, member(4, [-1])]))]
    met = [b.to_pylist() for b in md._meeting(md.match_threshold(85), 85)(iter([pa.RecordBatch.from_pylist(blocks)]))]
    pairs = {b[0]["key"]: {(r["side"], r["cls"][0]) for r in b} for b in met}
    assert pairs == {-3: {(s, i) for s in (0, 1) for i in range(4)}, -1: {(s, i) for s in (0, 1) for i in range(5)}}
    both = md._Sides(-1, blocks[2]["query"], blocks[2]["data"], md.match_threshold(85), 85)
    assert sorted(zip(both.ia.tolist(), both.ib.tolist())) == sorted([(i, 4) for i in range(4)] + [(4, i) for i in range(4)])


def one_list(classes, t):
    return classes.select("cls", F.lit(1).cast("long").alias("key"), F.lit(0).cast("long").alias("central"))


def test_lists_of_two_among_the_lists_posted_again(spark, monkeypatch):
    """Copies that only a long list holds together, and that share its further values with no other member."""
    monkeypatch.setattr(md, "prefix_postings", one_list)
    monkeypatch.setattr(md, "LONG", 5)
    rows = []
    for at, own in ((0, 120), (100, 40)):  # of sets posted under coordinates, and under shingles
        pages = [(at + i, " ".join(f"w{at + i}x{j}" for j in range(own))) for i in range(8)]
        rows += pages + [(50 + i, text + " more") for i, text in pages]
    out = run(spark, rows, 3, 85)
    assert out == brute(rows, 3, 85) and sum(not r[3] for r in out) == 16


def test_lists_of_one_number_are_one(spark):
    """x and y share a short list; each is in the main component of one of two longer lists whose numbers are equal."""
    corpus_session(spark)
    x = " ".join(f"w{i}" for i in range(60))
    texts = {"x": x, "y": x + " more"} | {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdeuv"}
    sets = dict(zip(texts, md.shingle_sets([t.encode() for t in texts.values()], 3)))
    rows = [(c.encode(), t.encode(), len(sets[c]), md.signature(sets[c]).view("int64").tolist()) for c, t in texts.items()]
    docs = spark.createDataFrame(rows, "cls binary, text binary, n_shingles long, sig array<long>")
    packed = md.compress_texts(docs.select("cls", "text"), "text").withColumn("zbytes", F.length("ztext").cast("long"))
    comps = {"u": "x", "v": "y"}
    members = spark.createDataFrame(
        [(c.encode(), key, comps.get(c, c).encode()) for key, of in ((5, "xuab"), (5 + 2**40, "yvcd"), (7, "xye")) for c in of],
        "cls binary, key long, comp binary")
    links = md.links_across(members, md.open_lists(members), docs.select("cls", "n_shingles", "sig"), packed, 3, 85, 1 << 18, 1 << 28)
    assert {frozenset(map(bytes, r)) for part in links for r in part.collect()} == {frozenset((b"x", b"y"))}


def test_passes_and_shuffle_files(spark, monkeypatch):
    """Many passes give all links; no job leaves its shuffle files."""
    corpus_session(spark)
    monkeypatch.setattr(md, "prefix_postings", one_list)
    monkeypatch.setattr(md, "BLOCK", 8)
    made, links_across = [], md.links_across
    monkeypatch.setattr(md, "links_across", lambda *a: made.append(links_across(*a[:-2], 150, 10_000)) or made[-1])
    rows = near_copies(3, groups=3, each=8)
    df = spark.createDataFrame(rows, SCHEMA)

    def shuffle_files():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before = shuffle_files()
    out = md.near_duplicates(df, 3, 85)
    assert not shuffle_files() - before
    assert len(made[0]) > 1
    assert sorted((tuple(r) for r in out.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str) == brute(rows, 3, 85)
