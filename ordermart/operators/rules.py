"""Fraud rules and decision (M1-M12, M15) as Catalyst expressions.

The reference scores row by row in Python (``mapInPandas`` + a dict per
event). Here every rule is a boolean column and the decision is one ``when``
chain, so scoring stays inside whole-stage codegen, in batch and in streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions import fixed

# --- fixed values: decision texts -------------------------------------------
REASON_BLACKLISTED = "Merchant %s is on the fraud watchlist"
REASON_VELOCITY = "Card exceeded %d transactions in 60s"
REASON_GEO = "Transaction location is physically impossible given previous activity"
REASON_MULTIPLE = "Multiple fraud signals detected: "
REASON_SUSPICIOUS = "Suspicious signals: "
REASON_NONE = "No fraud signals"


def blocklist_flag(tx: DataFrame, blocklist: Sequence[str] | DataFrame, merchant: str = "merchant_id") -> DataFrame:
    """``is_blacklisted_merchant``. A literal list becomes ``isin``; a
    table is joined (left, on the merchant): AQE broadcasts it when its real
    size allows and splits a hot merchant otherwise."""
    if not isinstance(blocklist, DataFrame):
        return tx.withColumn("is_blacklisted_merchant", F.col(merchant).isin(list(blocklist)))
    bl = blocklist.select(F.col(blocklist.columns[0]).alias("_bl_merchant")).distinct()
    j = tx.join(bl, F.col(merchant) == F.col("_bl_merchant"), "left")
    return j.withColumn("is_blacklisted_merchant", F.col("_bl_merchant").isNotNull()).drop("_bl_merchant")


def rule_columns(
    velocity_1min: int = fixed.VELOCITY_1MIN_THRESHOLD,
    velocity_5min: int = fixed.VELOCITY_5MIN_THRESHOLD,
    spike_multiplier: float = fixed.AMOUNT_SPIKE_MULTIPLIER,
    high_amount: float = fixed.HIGH_AMOUNT_NEW_DEVICE,
    max_speed_kmh: float = fixed.GEO_SPEED_KMH_MAX,
    cold_card_policy: str = "flag",
) -> dict[str, Column]:
    """M1-M7 over feature columns. The spike test compares exact decimals:
    ``amount * n > multiplier * sum`` is ``amount > multiplier * mean``.

    ``cold_card_policy``: a card with no 30-day history has no known devices
    or categories. ``"flag"`` (default, the reference behaviour) lets the
    new-device and unusual-category rules fire for it; ``"skip"`` keeps them
    silent until the card has history (only hard rules and velocity apply)."""
    amount = F.col("amount_usd")
    mult = F.lit(str(spike_multiplier)).cast("decimal(10,4)")
    warm = F.lit(True) if cold_card_policy == "flag" else ~is_cold()
    return {
        "blacklisted_merchant": F.coalesce(F.col("is_blacklisted_merchant"), F.lit(False)),
        "velocity_1min": F.col("tx_count_1min") >= velocity_1min,
        "velocity_5min": F.col("tx_count_5min") >= velocity_5min,
        "amount_spike": (F.col("amount_count_30d") > 0)
        & (F.col("amount_sum_30d") > 0)
        & (amount * F.col("amount_count_30d") > mult * F.col("amount_sum_30d")),
        "geo_impossibility": F.coalesce(F.col("speed_kmh") > max_speed_kmh, F.lit(False)),
        "new_device_high_amount": warm & ~F.coalesce(F.col("device_seen_90d"), F.lit(False)) & (amount > high_amount),
        "unusual_merchant_category": warm & F.coalesce(F.length(F.col("merchant_category")) > 0, F.lit(False))
        & ~F.coalesce(F.col("category_seen_30d"), F.lit(False)),
    }


def is_cold() -> Column:
    """No 30-day history for the card (empty profile)."""
    return F.coalesce(F.col("amount_count_30d"), F.lit(0)) == 0


def decide(df: DataFrame, review_accumulate: int = fixed.REVIEW_SCORE_ACCUMULATE, **thresholds) -> DataFrame:
    """M8: hard blocks first (blocklist, 1-minute velocity), then soft
    signals in order; geo-impossibility blocks and keeps the soft signals
    found before it; N or more soft signals block, one reviews."""
    r = rule_columns(**thresholds)

    def sig(name):
        return F.when(r[name], F.lit(name))

    before_geo = F.array_compact(F.array(sig("velocity_5min"), sig("amount_spike")))
    after_geo = F.array_compact(F.array(sig("new_device_high_amount"), sig("unusual_merchant_category")))
    triggered = (
        F.when(r["blacklisted_merchant"], F.array(F.lit("blacklisted_merchant")))
        .when(r["velocity_1min"], F.array(F.lit("velocity_1min")))
        .when(r["geo_impossibility"], F.concat(before_geo, F.array(F.lit("geo_impossibility"))))
        .otherwise(F.concat(before_geo, after_geo))
    )
    n = F.size(F.col("triggered_rules_list"))
    joined = F.array_join(F.col("triggered_rules_list"), ", ")
    hard = r["blacklisted_merchant"] | r["velocity_1min"] | r["geo_impossibility"]
    vel_threshold = thresholds.get("velocity_1min", fixed.VELOCITY_1MIN_THRESHOLD)
    return (
        df.withColumn("is_cold", is_cold())
        .withColumn("triggered_rules_list", triggered)
        .withColumn(
            "fraud_decision",
            F.when(hard | (n >= review_accumulate), F.lit("BLOCK")).when(n >= 1, F.lit("REVIEW")).otherwise(F.lit("PASS")),
        )
        .withColumn(
            "decision_reason",
            F.when(r["blacklisted_merchant"], F.format_string(REASON_BLACKLISTED, F.col("merchant_id")))
            .when(r["velocity_1min"], F.lit(REASON_VELOCITY % vel_threshold))
            .when(r["geo_impossibility"], F.lit(REASON_GEO))
            .when(n >= review_accumulate, F.concat(F.lit(REASON_MULTIPLE), joined))
            .when(n >= 1, F.concat(F.lit(REASON_SUSPICIOUS), joined))
            .otherwise(F.lit(REASON_NONE)),
        )
    )


SCORED_COLUMNS = [
    "transaction_id", "card_id", "customer_id", "amount_usd", "fraud_decision",
    "triggered_rules", "fraud_score", "decision_reason", "processed_at",
]


def score_projection(decided: DataFrame, processed_at: Column | str) -> DataFrame:
    """M9: the 9-column scored record; rules as a JSON array text."""
    ts = processed_at if isinstance(processed_at, Column) else F.lit(processed_at).cast("timestamp")
    return decided.select(
        "transaction_id", "card_id", "customer_id", "amount_usd", "fraud_decision",
        F.to_json(F.col("triggered_rules_list")).alias("triggered_rules"),
        F.lit(0.0).cast("float").alias("fraud_score"),
        "decision_reason",
        ts.alias("processed_at"),
    )


def score_batch(tx: DataFrame, blocklist: Sequence[str] | DataFrame, processed_at: str, **thresholds) -> DataFrame:
    """Whole rule set over a table of events (backtest)."""
    from ordermart.operators.features import offline_features

    feats = offline_features(tx)
    flagged = blocklist_flag(feats, blocklist)
    return score_projection(decide(flagged, **thresholds), processed_at)


def alerts(scored: DataFrame, actions: Sequence[str] = fixed.RISK_ACTIONS) -> DataFrame:
    """BLOCK and REVIEW only."""
    return scored.where(F.col("fraud_decision").isin(list(actions)))


def fraud_summary(scored: DataFrame) -> DataFrame:
    """Decisions with counts and amounts."""
    return scored.groupBy("fraud_decision").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount_usd").cast("decimal(18,4)").alias("amount_usd"),
        F.count_distinct("card_id").alias("cards"),
    )


def rule_hits(scored: DataFrame) -> DataFrame:
    """Hits per rule and decision (explode of the rule list)."""
    rules = F.from_json(F.col("triggered_rules"), "array<string>")
    return (
        scored.select("fraud_decision", F.explode(rules).alias("rule"))
        .groupBy("rule", "fraud_decision")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def score_bands(df: DataFrame, score: str = "fraud_score",
                block_above: float = fixed.SCORE_BLOCK_ABOVE, review_from: float = fixed.SCORE_REVIEW_FROM) -> DataFrame:
    """Band a supplied model probability: > 0.85 block, 0.6-0.85
    review, else pass."""
    s = F.col(score)
    return df.withColumn(
        "score_band",
        F.when(s > block_above, F.lit("BLOCK")).when(s >= review_from, F.lit("REVIEW")).otherwise(F.lit("PASS")),
    )
