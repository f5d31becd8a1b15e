"""Skew-safe keyed windows against brute force on a fixture where one key
holds a third of all rows, with equal timestamps and bucket-edge events."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermart.operators.fraud_windows import keyed_lag_lead, trailing_counts, trailing_stats

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        key = "HOT" if i % 3 == 0 else f"K{rnd.randint(0, 20)}"
        secs = rnd.randint(0, 40 * 86400) if i % 5 else rnd.randint(0, 3) * 300  # exact bucket edges
        ts = BASE + timedelta(seconds=secs, microseconds=rnd.choice([0, 0, 1, 500000]))
        rows.append((f"E{i:04d}", key, ts, Decimal(rnd.randint(1, 9999)) / 100))
    rows.append(("E9998", "HOT", rows[0][2], Decimal("1.00")))  # same instant as another event
    return spark.createDataFrame(rows, "id string, k string, ts timestamp, v decimal(18,2)")


def brute(rows, frame):
    out = {}
    for r in rows:
        prior = [x for x in rows if x["k"] == r["k"] and r["ts"] - frame <= x["ts"] < r["ts"]]
        out[r["id"]] = (len(prior), sum((x["v"] for x in prior), Decimal(0)))
    return out


@pytest.mark.parametrize("frame_s,unit_s", [(60, None), (300, None), (30 * 86400, 86400), (3 * 3600, 3600)])
def test_trailing_stats_exact(events, frame_s, unit_s):
    rows = events.collect()
    want = brute(rows, timedelta(seconds=frame_s))
    got = trailing_stats(events, ["k"], "ts", frame_s, unit_s, values={"v": F.col("v")}).collect()
    assert {r["id"]: (r["w_count"], Decimal(r["w_sum_v"])) for r in got} == want


def test_trailing_counts_multi_frame(events):
    rows = events.collect()
    w1, w5 = brute(rows, timedelta(seconds=60)), brute(rows, timedelta(seconds=300))
    got = trailing_counts(events, ["k"], "ts", {"c1": 60, "c5": 300}).collect()
    assert {r["id"]: (r["c1"], r["c5"]) for r in got} == {i: (w1[i][0], w5[i][0]) for i in w1}


@pytest.mark.parametrize("direction", ["lag", "lead"])
def test_keyed_lag_lead(events, direction):
    rows = sorted(events.collect(), key=lambda r: (r["k"], r["ts"], r["id"]))
    want = {}
    for i, r in enumerate(rows):
        j = i - 1 if direction == "lag" else i + 1
        ok = 0 <= j < len(rows) and rows[j]["k"] == r["k"]
        want[r["id"]] = rows[j]["id"] if ok else None
    got = keyed_lag_lead(events, ["k"], "ts", ["id"], direction=direction, tie="id",
                         bucket_seconds=86400, prefix="p_").collect()
    assert {r["id"]: r["p_id"] for r in got} == want


def test_hot_key_is_split_across_buckets(events):
    """The window partitions are (key, bucket): the hot key spreads over
    many partitions instead of one."""
    b = events.where("k = 'HOT'").select(F.floor(F.unix_seconds("ts") / 86400).alias("b")).distinct().count()
    assert b > 20


def test_trailing_stats_with_lag_in_same_pass(events):
    rows = sorted(events.collect(), key=lambda r: (r["k"], r["ts"], r["id"]))
    want_prev = {}
    for i, r in enumerate(rows):
        ok = i > 0 and rows[i - 1]["k"] == r["k"]
        want_prev[r["id"]] = rows[i - 1]["id"] if ok else None
    want = brute(rows, timedelta(days=30))
    got = trailing_stats(events, ["k"], "ts", 30 * 86400, 86400, values={"v": F.col("v")},
                         lag_cols=["id"], tie="id", lag_prefix="p_").collect()
    assert {r["id"]: r["p_id"] for r in got} == want_prev
    assert {r["id"]: (r["w_count"], Decimal(r["w_sum_v"])) for r in got} == want


def test_as_of_join_matches_brute_force(spark):
    from ordermart.operators.change import as_of_join

    rnd = random.Random(3)
    hist, facts = [], []
    for key, n_versions in [("HOT", 60), ("A", 3), ("B", 1), ("C", 0)]:
        t = BASE
        for v in range(n_versions):
            start = t
            t = t + timedelta(days=rnd.randint(1, 40))
            end = None if v == n_versions - 1 and key != "B" else t  # B's only version is closed
            hist.append((key, f"{key}-v{v}", start, end))
    for i in range(600):
        key = "HOT" if i % 3 else rnd.choice(["A", "B", "C"])
        ts = BASE + timedelta(days=rnd.randint(-5, 2500), seconds=rnd.randint(0, 86399))
        facts.append((f"F{i}", key, ts))
    facts += [("EQ", "HOT", hist[5][2])]  # exactly at a version start
    h = spark.createDataFrame(hist, "customer_id string, customer_tier string, valid_from timestamp, valid_to timestamp")
    f = spark.createDataFrame(facts, "order_id string, customer_id string, ts timestamp")
    want = {}
    for oid, key, ts in facts:
        m = [v for (k, v, s, e) in hist if k == key and s <= ts and (e is None or ts < e)]
        want[oid] = m[0] if m else None
    got = {r["order_id"]: r["customer_tier_at_event"] for r in as_of_join(f, h, "customer_id", "ts").collect()}
    assert got == want
    assert got["EQ"] == "HOT-v5"


def test_keyed_prev_time(events):
    from ordermart.operators.fraud_windows import keyed_prev_time

    rows = events.collect()
    want = {}
    for r in rows:
        earlier = [x["ts"] for x in rows if x["k"] == r["k"] and x["ts"] < r["ts"]]
        want[r["id"]] = max(earlier) if earlier else None
    got = keyed_prev_time(events, ["k"], "ts", out="p").withColumn("p", F.timestamp_micros("p")).collect()
    assert {r["id"]: r["p"] for r in got} == want
