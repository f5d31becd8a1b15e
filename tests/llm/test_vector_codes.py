"""Product codes against plain loops; the bounds never change an assignment."""

import math
import random

import numpy as np
import pytest

from ordermart.llm import vector_codes as vc
from ordermart.llm.common import corpus_session


def brute(rows, parts, entries, rounds, scale):
    """rows: (vec_id, vector, label) -> sorted (vec_id, code, error, label_error), codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = next((len(r[1]) for r in order if r[1] and len(r[1]) % parts == 0), None)
    if dim is None:
        return [], []
    kept, order = ([r for r in x if len(r[1]) == dim] for x in (kept, order))
    size = dim // parts

    def cut(v):
        v = [max(-vc.LIMIT, min(vc.LIMIT, math.floor(scale * x))) for x in v]
        return [v[p * size:(p + 1) * size] for p in range(parts)]

    cuts = [cut(r[1]) for r in kept]
    books = [[cut(r[1])[p] for r in order[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            hit = {}
            for c in cuts:
                hit.setdefault(nearest(p, c[p])[1], []).append(c[p])
            new.append([[sum(x) // len(hit[k]) for x in zip(*hit[k])] if k in hit else e for k, e in enumerate(books[p])])
        books = new
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cuts]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for r, e in zip(kept, errors):
        totals[r[2]] = totals.get(r[2], 0) + e
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), e, totals[r[2]]) for r, f, e in zip(kept, found, errors)]
    return sorted(out, key=str), books


def run(spark, rows, **kw):
    corpus_session(spark)
    df = spark.createDataFrame([(i, v, g, "x", 1) for i, v, g in rows],
                               "vec_id long, embedding array<double>, label int, code string, error int").repartition(3)
    coded, books = vc.compress(df, **kw)
    got = sorted(((r["vec_id"], bytes(r["code"]).hex(), r["error"], r["label_error"])
                  for r in vc.with_label_error(coded).collect()), key=str)
    return got, books.tolist()


def sample(seed, n, dim, values):
    rng = random.Random(seed)
    rows = [(rng.randrange(n), [rng.choice(values) for _ in range(dim)], rng.choice([None, 1, 2])) for _ in range(n)]
    return rows + [(None, [0.5] * dim, 1), (-5, None, 1), (-6, [1.0] * (dim - 1) + [None], 1), (-7, [math.nan] * dim, None),
                   (-8, [math.inf] + [0.0] * (dim - 1), 2), (-9, [1.0] * (dim + 1), 2), (-10, [], 2), rows[0], rows[0],
                   (n, [1e300] + [-1e300] * (dim - 1), 3)]


@pytest.mark.parametrize("seed,values,kw", [
    (1, [-0.5, 0.0, 0.25, 0.5], dict(parts=4, entries=5, rounds=2, scale=256, groups=2)),  # many ties
    (2, [x / 97 for x in range(-97, 98)], dict(parts=4, entries=16, rounds=4, scale=256, groups=3)),
    (3, [x / 9 for x in range(-9, 10)], dict(parts=2, entries=300 // 2, rounds=3, scale=4, groups=8)),
    (4, [x / 9 for x in range(-9, 10)], dict(parts=8, entries=7, rounds=0, scale=10, groups=1))])
def test_matches_brute_force(spark, seed, values, kw):
    rows = sample(seed, 120, 8, values)
    plain = {k: v for k, v in kw.items() if k != "groups"}
    want, books = brute(rows, **plain)
    got, got_books = run(spark, rows, **kw)
    assert got_books == books and got == want and want


def test_few_rows_and_empty_table(spark):
    kw = dict(parts=4, entries=64, rounds=2, scale=256)
    assert run(spark, [(1, [0.1] * 8, None)], **kw) == brute([(1, [0.1] * 8, None)], **kw)
    assert run(spark, [], **kw)[0] == [] and run(spark, [(1, None, 1), (2, [1.0] * 7, 1)], **kw)[0] == []


@pytest.mark.parametrize("top", [50, 2**25])
def test_bounds_hold_through_long_histories_and_spare_scans(top):
    """Codebooks that wander and return: net displacements keep bounds that summed drifts would lose."""
    rng = np.random.default_rng(8)
    x = rng.integers(-top, top + 1, (400, 4, 3))
    c = rng.integers(-top, top + 1, (4, 20, 3))
    history, spared = [c], 0
    state = vc.first_scan(x, c, 4)
    for t in range(12):
        step = rng.integers(-max(1, top // 25), max(1, top // 25) + 1, c.shape)
        history.append(np.clip(history[-1] + step if t % 2 else history[max(0, t - 1)] + step // 3, -top, top))
        state, scanned = vc.next_scan(x, np.array(history), state)
        full = vc.first_scan(x, history[-1], 4)
        assert (state.code == full.code).all()
        spared += int((scanned == 0).sum())
        # every bound, moved by net displacement, is on the right side of the true distances
        for p in range(4):
            d = np.sqrt(np.square(x[:, p, None] - history[-1][p]).sum(2).astype(float))
            own = d[np.arange(len(d)), state.code[:, p]]
            moved = np.sqrt(np.square(np.array(history) - history[-1]).sum(3))
            assert (state.upper[:, p] + moved[state.upper_at[:, p], p, state.code[:, p]] >= own * (1 - 1e-9)).all()
    assert spared > 0.3 * 12 * 400 * 4


def test_net_displacement_is_tighter_than_drifts():
    a, b = np.zeros((1, 2, 1), np.int64), np.array([[[9], [9]]])
    history = np.array([a, b, a])
    assert vc._moves(history)[0].max() == 0  # summed drifts would be 18


def test_one_label_in_most_rows_is_spread(spark):
    corpus_session(spark)
    df = spark.range(2000).selectExpr("id AS vec_id", "CAST(IF(id % 3 = 0, NULL, 1) AS INT) AS label",
                                      "unhex('00') AS code", "id AS error")
    got = {r["label"]: r["label_error"] for r in vc.with_label_error(df).select("label", "label_error").distinct().collect()}
    assert got == {None: sum(range(0, 2000, 3)), 1: sum(i for i in range(2000) if i % 3)}
