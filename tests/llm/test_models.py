"""Quality classifier and language ID: held-out accuracy, exactness of the parts, odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from ordermart.llm import language_id as li
from ordermart.llm import quality_classifier as qc
from ordermart.llm.common import Texts, corpus_session

SF = "/root/testdata/sf0.01"


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_words_and_hashes_of_byte_spans():
    rng = random.Random(3)
    for _ in range(200):
        texts = ["".join(rng.choice("aB \n\té") for _ in range(rng.randrange(20))).encode() for _ in range(rng.randrange(5))]
        t = Texts(texts)
        starts, ends = t.words()
        want = [(i, w) for i, x in enumerate(texts) for w in x.split()]
        assert [(int(i), t.data[a:b].tobytes()) for i, a, b in zip(t.owner(starts), starts, ends)] == want
        by_word = {}
        for (_, w), h in zip(want, t.hashes(starts, ends)):
            assert by_word.setdefault(w, h) == h
        assert len(set(by_word.values())) == len(by_word)


def test_hash_of_a_span_longer_than_a_block():
    t = Texts([b"x" * 700_000 + b" ab ab " + b"y" * 400_000 + b" ab"])
    h = t.hashes(*t.words())
    assert h[1] == h[2] == h[4] and len(set(h)) == 3


def test_classifier_on_held_out_documents(spark):
    rows = e.queries()["op2_quality_classifier"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_classifier_odd_rows(spark):
    corpus_session(spark)
    good, bad = "a calm and plain line of words " * 5, "BUY!!! $$$ *** NOW!!! " * 8
    rows = [(i, good if i % 2 else bad, "x") for i in range(1, 200)] + [
        (300, None, "x"), (301, "", "x"), (302, good * 300, "x"), (None, good, "x"), (7, good, "x"), (303, bad, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, "q") for i in range(1, 150)] + [(150, None, "q"), (None, 1, "q"), (7, 1, "q")],
                                   "doc_id long, quality int, text string")
    out = qc.classify(docs, labels).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[301].score == by_id[300].score
    assert by_id[302].predicted == 1 and by_id[303].predicted == 0 and by_id[None].predicted == 1
    assert len({r.score for r in out if r.doc_id == 7}) == 1
    assert by_id[None].held_out is False
    assert {r.score for r in qc.classify(docs, labels.where("false")).collect()} == {0.5}
    assert qc.classify(docs.where("false"), labels).count() == 0
    kept = qc.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id = 303").count() == 0 and kept.where("doc_id = 302").count() == 1


def test_sample_is_bounded_and_leaves_the_held_out_fold(spark):
    docs = spark.range(1, 400).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    got = qc.labelled_sample(docs, labels, sample=50)
    assert got.count() == 50
    keys = {r[0] for r in docs.where("crc32(string(doc_id)) % 5 = 0").select(F.xxhash64("doc_id")).collect()}
    assert not keys & {r["key"] for r in got.collect()}


def test_language_on_held_out_documents(spark):
    rows = e.queries()["op3_language_id"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [(r.lang_pred, lang[r.doc_id]) for r in rows if r.held_out]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)


def test_language_odd_rows(spark):
    corpus_session(spark)
    words = {"aa": "lorem ipsum dolor amet sit".split(), "bb": "zwei drei vier uhr tag".split()}
    rng = random.Random(1)
    text = lambda k: " ".join(rng.choice(words[k]) for _ in range(40))
    rows = [(i, text(k), k, "s") for i, k in zip(range(120), itertools.cycle(words))]
    rows += [(200, None, "aa", "s"), (201, "", "aa", "s"), (202, "12 -- 34 €", "bb", "s"), (203, text("bb") * 400, None, "s"),
             (None, text("aa"), "bb", "s"), (204, "ñ", None, "s"), (3, text("bb"), "bb", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = li.identify(docs).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (200, 201, 202))
    assert by_id[203].lang_pred == "bb" and by_id[None].lang_pred == "aa" and by_id[204].lang_pred in words
    assert all(r.lang_pred == rows[i][2] for i, r in ((i, by_id[i]) for i in range(120) if i != 3))
    assert {r.lang_pred for r in li.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert li.identify(docs.where("false")).count() == 0


def test_rare_language_is_learned_and_the_sample_is_bounded(spark):
    corpus_session(spark)
    words = {"aa": "lorem ipsum dolor amet sit".split(), "bb": "zwei drei vier uhr tag".split(), "rare": "yksi kaksi kolme nelja".split()}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(8)), k)
            for i, k in enumerate(["aa"] * 2500 + ["bb"] * 2500 + ["rare"] * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    runs = li.training_runs(docs, 40)
    assert "WindowGroupLimit" in runs._jdf.queryExecution().executedPlan().toString()
    got = {r.lang: {x.key for x in runs.where(F.col("lang") == r.lang).collect()} for r in runs.select("lang").distinct().collect()}
    usable = [(i, k) for i, _, k in rows if crc(i, 4) != 2]
    assert {k: len(v) for k, v in got.items()} == {k: min(40, sum(x == k for _, x in usable)) for k in words}
    keys = {r.doc_id: r.key for r in docs.select("doc_id", F.xxhash64("doc_id").alias("key")).collect()}
    assert all(v == set(sorted(keys[i] for i, x in usable if x == k)[:40]) for k, v in got.items())
    out = {r.doc_id: r.lang_pred for r in li.identify(docs, li.train(docs, 40)).collect()}
    assert all(out[i] == k for i, _, k in rows)
    assert li.SAMPLE <= 1000  # spark.sql.optimizer.windowGroupLimitThreshold


def test_code_switched_words_follow_their_language():
    rng = random.Random(2)
    words = {"aa": [f"{x}um" for x in "lor ips dol am sit fer ver".split()], "bb": [f"{x}en" for x in "zwei drei vier uhr tag gut".split()]}
    runs = [(k, [rng.choice(words[k]).encode() for _ in range(8)]) for _ in range(200) for k in words]
    rng.shuffle(runs)
    model = li.fit(runs)
    assert model.transitions[0, 0] > model.transitions[0, 1] and model.transitions[1, 1] > model.transitions[1, 0]
    (first, share), = li.predict([b" ".join(w for k in ("aa", "bb", "aa") for w in [x.encode() for x in words[k]])], model)
    assert first == "aa" and 0.5 < share < 0.9


@pytest.mark.parametrize("steps", [1, 2, 5])
def test_forward_backward_equals_enumeration(steps):
    rng = np.random.default_rng(steps)
    scores, trans = rng.normal(size=(2, 6, 3)), rng.normal(size=(3, 3))
    real = np.zeros((2, 6), bool)
    real[0, :steps], real[1, :6] = True, True
    post = li.forward_backward(scores, real, trans)[0]
    for s, n in ((0, steps), (1, 6)):
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            p = np.exp(sum(scores[s, t, k] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            for t, k in enumerate(path):
                want[t, k] += p
        assert np.allclose(post[s, :n], want / want.sum(axis=1, keepdims=True))


def test_empty_spans_at_the_end_of_a_block():
    from ordermart.llm.common import _BLOCK

    t = Texts([b"a" * (_BLOCK - 1) + b" -- b"])
    h = t.hashes(np.array([0, _BLOCK, _BLOCK + 3]), np.array([_BLOCK - 1, _BLOCK, _BLOCK + 4]))
    assert len(set(h.tolist())) == 3
