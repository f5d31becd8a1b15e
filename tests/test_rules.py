"""Rule and decision boundaries (M1-M9) on hand-built feature rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermart.operators import rules

COLS = ("transaction_id string, merchant_id string, amount_usd decimal(18,4), tx_count_1min bigint, "
        "tx_count_5min bigint, amount_count_30d bigint, amount_sum_30d decimal(28,4), speed_kmh double, "
        "device_seen_90d boolean, merchant_category string, category_seen_30d boolean")


def row(**kw):
    base = dict(transaction_id="T", merchant_id="M-1", amount_usd=Decimal("10"), tx_count_1min=0, tx_count_5min=0,
                amount_count_30d=10, amount_sum_30d=Decimal("100"), speed_kmh=None, device_seen_90d=True,
                merchant_category="web", category_seen_30d=True)
    base.update(kw)
    return tuple(base[c.split()[0]] for c in COLS.split(", "))


def decide(spark, blocklist=("M-13",), **kw):
    df = spark.createDataFrame([row(**kw)], COLS)
    return rules.decide(rules.blocklist_flag(df, list(blocklist))).first()


@pytest.mark.parametrize("n,hit", [(4, False), (5, True)])
def test_velocity_1min(spark, n, hit):
    assert (decide(spark, tx_count_1min=n)["fraud_decision"] == "BLOCK") is hit


@pytest.mark.parametrize("n,hit", [(9, False), (10, True)])
def test_velocity_5min(spark, n, hit):
    assert ("velocity_5min" in decide(spark, tx_count_5min=n)["triggered_rules_list"]) is hit


@pytest.mark.parametrize("amount,hit", [("30.0000", False), ("30.0001", True)])
def test_amount_spike_exactly_three_times(spark, amount, hit):
    assert ("amount_spike" in decide(spark, amount_usd=Decimal(amount))["triggered_rules_list"]) is hit


def test_amount_spike_never_without_history(spark):
    r = decide(spark, amount_usd=Decimal("9999"), amount_count_30d=0, amount_sum_30d=Decimal(0))
    assert "amount_spike" not in r["triggered_rules_list"]


@pytest.mark.parametrize("speed,hit", [(900.0, False), (900.01, True), (None, False)])
def test_geo(spark, speed, hit):
    r = decide(spark, speed_kmh=speed)
    assert (r["fraud_decision"] == "BLOCK" and "geo_impossibility" in r["triggered_rules_list"]) is hit


@pytest.mark.parametrize("amount,seen,hit", [("500", False, False), ("500.01", False, True), ("900", True, False),
                                             ("900", None, True)])
def test_new_device_high_amount(spark, amount, seen, hit):
    r = decide(spark, amount_usd=Decimal(amount), device_seen_90d=seen, amount_sum_30d=Decimal("100000"))
    assert ("new_device_high_amount" in r["triggered_rules_list"]) is hit


@pytest.mark.parametrize("cat,seen,hit", [("web", False, True), ("", False, False), (None, False, False), ("web", True, False)])
def test_unusual_category(spark, cat, seen, hit):
    r = decide(spark, merchant_category=cat, category_seen_30d=seen)
    assert ("unusual_merchant_category" in r["triggered_rules_list"]) is hit


def test_decisions_by_signal_count(spark):
    assert decide(spark)["fraud_decision"] == "PASS"
    assert decide(spark)["decision_reason"] == "No fraud signals"
    one = decide(spark, tx_count_5min=10)
    assert (one["fraud_decision"], one["decision_reason"]) == ("REVIEW", "Suspicious signals: velocity_5min")
    two = decide(spark, tx_count_5min=10, category_seen_30d=False)
    assert two["fraud_decision"] == "BLOCK"
    assert two["decision_reason"] == "Multiple fraud signals detected: velocity_5min, unusual_merchant_category"


def test_hard_block_order(spark):
    r = decide(spark, merchant_id="M-13", tx_count_1min=9)
    assert list(r["triggered_rules_list"]) == ["blacklisted_merchant"]
    assert r["decision_reason"] == "Merchant M-13 is on the fraud watchlist"
    r = decide(spark, tx_count_1min=9, tx_count_5min=20)
    assert list(r["triggered_rules_list"]) == ["velocity_1min"]


def test_geo_keeps_earlier_soft_signals_only(spark):
    r = decide(spark, tx_count_5min=10, speed_kmh=5000.0, category_seen_30d=False)
    assert list(r["triggered_rules_list"]) == ["velocity_5min", "geo_impossibility"]
    assert r["fraud_decision"] == "BLOCK"


def test_blocklist_table_join(spark):
    df = spark.createDataFrame([row(merchant_id="M-7")], COLS)
    bl = spark.createDataFrame([("M-7",)], "merchant_id string")
    assert rules.blocklist_flag(df, bl).first()["is_blacklisted_merchant"] is True


def test_score_projection_and_bands(spark):
    df = spark.createDataFrame([row(tx_count_5min=10)], COLS).withColumn("card_id", F.lit("C")).withColumn(
        "customer_id", F.lit("U"))
    s = rules.score_projection(rules.decide(rules.blocklist_flag(df, [])), "2024-01-01 00:00:00").first()
    assert s["triggered_rules"] == '["velocity_5min"]' and s["fraud_score"] == 0.0
    b = spark.createDataFrame([(0.9,), (0.85,), (0.6,), (0.59,)], "fraud_score double")
    assert [r["score_band"] for r in rules.score_bands(b).collect()] == ["BLOCK", "REVIEW", "REVIEW", "PASS"]


def test_cold_card_policy(spark):
    cold = dict(amount_count_30d=0, amount_sum_30d=Decimal(0), device_seen_90d=None, category_seen_30d=None,
                amount_usd=Decimal("800"))
    df = spark.createDataFrame([row(**cold)], COLS)
    flagged = rules.decide(rules.blocklist_flag(df, [])).first()
    assert flagged["is_cold"] is True and flagged["fraud_decision"] == "BLOCK"   # new device + category
    skipped = rules.decide(rules.blocklist_flag(df, []), cold_card_policy="skip").first()
    assert skipped["fraud_decision"] == "PASS"
