"""The quality classifier against plain Python: n-grams as strings, FTRL over dictionaries, scores as sums."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import quality_classifier as qc
from ordermart.llm.common import corpus_session

TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+")


def shape(token: bytes):
    capital, small = (sum(c in r for c in token) for r in (range(65, 91), range(97, 123)))
    if not re.match(rb"[A-Za-z0-9\x80-\xff]", token):
        return token
    if token[:1].isdigit():
        return 1
    if capital and not small:
        return 2 if len(token) > 1 else 3
    return 4 if token[0] in range(65, 91) else 5


def grams(texts):
    """The n-grams in the order of the arrays: per kind, (text, n-gram)."""
    kinds = [[], [], [], [], []]
    for i, text in enumerate(texts):
        t = TOKEN.findall(text)
        low, s = [x.lower() for x in t], [shape(x) for x in t]
        for kind, items, n in ((0, low, 1), (1, low, 2), (2, s, 1), (3, s, 2), (4, s, 3)):
            kinds[kind] += [(i, (kind, *items[j:j + n])) for j in range(len(t) - n + 1)]
    return [x for kind in kinds for x in kind]


def random_texts(seed, n):
    rng = random.Random(seed)
    bits = ["The", "cat", "CAT", "a", "A", "Éa", "漢字", "12", "3", "!!", "...", "#", " ", "  ", "\n", "x1", "Q&A", "don't"]
    return [" ".join(rng.choice(bits) + rng.choice(["", rng.choice(bits)]) for _ in range(rng.randrange(0, 30))).encode() for _ in range(n)]


def test_ngrams_equal_strings():
    texts = [*random_texts(1, 200), b"", b" \n", "long ".encode() * 3000]
    owner, at, n = qc.ngrams(texts)
    want = grams(texts)
    assert owner.tolist() == [i for i, _ in want]
    assert n.tolist() == [len(TOKEN.findall(t)) for t in texts]
    place = {}
    for a, (_, g) in zip(at.tolist(), want):
        assert place.setdefault(g, a) == a  # an n-gram always has the same coordinate
    assert len(set(place.values())) > 0.99 * len(place)  # and few share one


def brute_ftrl(rows):
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        if k == "bias":
            return -z[k] / ((qc.BETA + math.sqrt(n[k])) / qc.ALPHA)
        if abs(z[k]) <= qc.L1:
            return 0.0
        return -(z[k] - math.copysign(qc.L1, z[k])) / ((qc.BETA + math.sqrt(n[k])) / qc.ALPHA + qc.L2)

    for y, features in rows:
        x = {**features, "bias": 1.0}
        w = {k: weight(k) for k in x}
        p = 1 / (1 + math.exp(-max(-50, min(50, sum(w[k] * v for k, v in x.items())))))
        for k, v in x.items():
            g = (p - y) * v
            sigma = (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / qc.ALPHA
            z[k] += g - sigma * w[k]
            n[k] += g * g
    return {k: weight(k) for k in z}


def sparse(text):
    _, at, (n,) = qc.ngrams([text])
    return {k: np.float32(qc.SCALE * c / max(n, 1)).item() for k, c in Counter(at.tolist()).items()}


def test_ftrl_and_scores_equal_dictionaries():
    texts = random_texts(2, 150)
    rows = [(i % 3 == 0, sparse(t)) for i, t in enumerate(texts)]
    want = brute_ftrl(rows)
    model = qc.ftrl((y, np.array(sorted(f), np.int64), np.array([f[k] for k in sorted(f)])) for y, f in rows)
    assert math.isclose(model.bias, want.pop("bias"), rel_tol=1e-9)
    assert set(np.flatnonzero(model.weights).tolist()) == {k for k, w in want.items() if w}
    assert all(math.isclose(model.weights[k], w, rel_tol=1e-5, abs_tol=1e-7) for k, w in want.items())
    tests = [*random_texts(3, 50), b""]
    for got, t in zip(model.score(tests).tolist(), tests):
        _, at, (n,) = qc.ngrams([t])
        s = model.bias + sum(qc.SCALE * c * float(model.weights[k]) / max(n, 1) for k, c in Counter(at.tolist()).items())
        assert math.isclose(got, 1 / (1 + math.exp(-s)), rel_tol=1e-6)


def test_training_equals_the_brute_order(spark):
    """The model from Spark is that of the labelled rows in their documented order, EPOCHS times over."""
    corpus_session(spark)
    texts = random_texts(4, 60)
    rows = [(i * 7919, int(i % 3 == 0), t.decode()) for i, t in enumerate(texts)]
    sample = spark.createDataFrame(rows, "key long, y int, text string").repartition(3)
    model = qc.train(sample)
    order = (sample.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(qc.EPOCHS))))
             .orderBy("epoch", F.xxhash64("key", "epoch"), "key").select("y", "text").collect())
    want = brute_ftrl([(r.y, sparse(r.text.encode())) for r in order])
    assert math.isclose(model.bias, want.pop("bias"), rel_tol=1e-9)
    assert all(math.isclose(model.weights[k], w, rel_tol=1e-5, abs_tol=1e-7) for k, w in want.items())
