"""Registered queries: one callable per operator key, each ``(spark, sf_dir)``
-> DataFrame over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators import clean, gold
from ordermart.session import cut_lineage, prepare_session
from ordermart.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LTV_AS_OF = "2001-08-01"
LTV_AS_OF_EARLY = "1998-06-30"


def query(name: str):
    """Register ``fn(spark, sf_dir)``; the caller's session is prepared first
    (UTC clock, shared checkpoint folder when none is set)."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf)
        QUERIES[name] = run
        return fn
    return deco


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return A.load_table(spark, sf, "orders")


# Stand-in inputs written once as Parquet (as the lake hands layers over);
# when set for an ``sf`` folder, queries read them instead of re-deriving.
MATERIALIZED: dict[tuple[str, str], str] = {}


def _stand_in(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    path = MATERIALIZED.get((sf, name))
    return spark.read.parquet(path) if path else build()


def materialize_inputs(spark: SparkSession, sf: str, root: str) -> dict[str, str]:
    """Write the stand-in inputs (bronze rows, customer extract, card
    transactions) to ``root`` and route later queries on ``sf`` to them."""
    builders = {
        "bronze": lambda: A.bronze_rows(_orders(spark, sf), dirty=True),
        "customers_src": lambda: A.customers_src(A.load_table(spark, sf, "customer")),
        "transactions": lambda: A.transactions_burst(A.load_table(spark, sf, "events")),
    }
    for name, build in builders.items():
        path = f"{root}/{name}"
        build().write.mode("overwrite").parquet(path)
        MATERIALIZED[(sf, name)] = path
    return {n: MATERIALIZED[(sf, n)] for n in builders}


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _stand_in(spark, sf, "bronze", lambda: A.bronze_rows(_orders(spark, sf), dirty=True))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_orders(bronze(spark, sf))[0]


SILVER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_total_amount", "currency_code",
    "channel", "shipping_country", "item_count", "order_created_at", "order_updated_at",
    "order_date", "order_total_usd", "is_high_value", "order_size_tier", "is_international",
]


# --- Silver -----------------------------------------------------------------
@query("silver_cast_normalise")
def q_silver_cast(spark, sf):
    return clean.cast_and_normalise(bronze(spark, sf)).select(
        "order_id", "customer_id", "order_status", "order_total_amount", "currency_code",
        "channel", "shipping_country", "item_count", "order_created_at", "order_updated_at", "order_date",
    )


@query("silver_valid")
def q_silver_valid(spark, sf):
    valid, _ = clean.split_invalid(clean.cast_and_normalise(bronze(spark, sf)))
    return valid.select("order_id", "order_status", "order_total_amount", "order_updated_at", "channel", "currency_code")


@query("silver_invalid")
def q_silver_invalid(spark, sf):
    _, invalid = clean.split_invalid(clean.cast_and_normalise(bronze(spark, sf)))
    return invalid.select("order_id", "customer_id", "order_status", "order_total_amount", "channel", "_quarantine_reason")


@query("silver_dedup_latest")
def q_silver_dedup(spark, sf):
    valid, _ = clean.split_invalid(clean.cast_and_normalise(bronze(spark, sf)))
    return clean.latest_per_key(valid).select("order_id", "order_status", "order_updated_at", "_cdc_operation")


@query("silver_fx_usd")
def q_silver_fx(spark, sf):
    valid, _ = clean.split_invalid(clean.cast_and_normalise(bronze(spark, sf)))
    return clean.fx_lookup(clean.latest_per_key(valid)).select("order_id", "currency_code", "order_total_amount", "order_total_usd")


@query("silver_flags")
def q_silver_flags(spark, sf):
    return silver(spark, sf).select("order_id", "is_high_value", "order_size_tier", "is_international")


@query("silver_orders")
def q_silver_orders(spark, sf):
    return silver(spark, sf).select(SILVER_COLUMNS)


# --- Gold -------------------------------------------------------------------
@query("ltv_totals")
def q_ltv_totals(spark, sf):
    return gold.ltv_aggregates(silver(spark, sf), LTV_AS_OF).select(
        "customer_id", "total_orders", "first_order_date", "last_order_date")


@query("ltv_completed")
def q_ltv_completed(spark, sf):
    return gold.ltv_aggregates(silver(spark, sf), LTV_AS_OF).select(
        "customer_id", "completed_orders", "total_revenue_usd", "avg_order_value_usd")


@query("ltv_cancelled")
def q_ltv_cancelled(spark, sf):
    return gold.ltv_aggregates(silver(spark, sf), LTV_AS_OF).select("customer_id", "cancelled_orders")


@query("ltv_l12m")
def q_ltv_l12m(spark, sf):
    return gold.ltv_aggregates(silver(spark, sf), LTV_AS_OF).select("customer_id", "orders_l12m", "revenue_l12m_usd")


@query("customer_ltv")
def q_customer_ltv(spark, sf):
    return gold.compute_ltv_metrics(silver(spark, sf), LTV_AS_OF)


@query("ltv_join_variant")
def q_ltv_join_variant(spark, sf):
    return gold.ltv_metrics_by_class(silver(spark, sf), LTV_AS_OF)


@query("ltv_segments")
def q_ltv_segments(spark, sf):
    return gold.compute_ltv_metrics(silver(spark, sf), LTV_AS_OF_EARLY, l12m_upper_bound=True)


@query("ltv_segment_counts")
def q_ltv_segment_counts(spark, sf):
    return gold.segment_counts(gold.compute_ltv_metrics(silver(spark, sf), LTV_AS_OF_EARLY, l12m_upper_bound=True))


# --- Marts ------------------------------------------------------------------
from ordermart.operators import change, features, marts, rules  # noqa: E402

AS_OF_TS = "2001-08-02 06:00:00"
INCREMENTAL_TARGET_BEFORE = "2000-01-01"
SNAPSHOT_RUN_TS = "2002-01-01 00:00:00"
BLOCKLISTED_MERCHANTS = ["M-13", "M-42"]
PROFILE_DATE = "2024-01-20"


def stg_orders(spark, sf):
    return marts.stage_orders(silver(spark, sf))


def stg_customers(spark, sf):
    return marts.stage_customers(_stand_in(spark, sf, "customers_src",
                                           lambda: A.customers_src(A.load_table(spark, sf, "customer"))))


def enriched(spark, sf):
    return marts.enrich_orders(stg_orders(spark, sf), stg_customers(spark, sf))


def fct(spark, sf):
    return marts.fct_orders(enriched(spark, sf), AS_OF_TS)


def fct_previous_run(spark, sf):
    """The fact table as an earlier run left it: built from first CDC
    versions only, up to a cut-off date."""
    first = A.bronze_rows(_orders(spark, sf)).where(F.col("_cdc_operation") == "c")
    prev_silver = clean.silver_orders(first)[0]
    prev = marts.fct_orders(marts.enrich_orders(marts.stage_orders(prev_silver), stg_customers(spark, sf)), AS_OF_TS)
    return prev.where(F.col("order_date") < F.lit(INCREMENTAL_TARGET_BEFORE).cast("date"))


def fct_incremental(spark, sf, target=None):
    target = fct_previous_run(spark, sf) if target is None else target
    wm = change.read_target_watermark(target)
    return change.incremental_lookback(fct(spark, sf), wm)


@query("stg_orders")
def q_stg_orders(spark, sf):
    return stg_orders(spark, sf)


@query("stg_customers")
def q_stg_customers(spark, sf):
    return stg_customers(spark, sf)


@query("orders_enriched")
def q_orders_enriched(spark, sf):
    return enriched(spark, sf).select(
        "order_id", "customer_id", "customer_tier", "customer_country", "acquisition_channel",
        "days_since_customer_signup", "is_cross_border", "revenue_band")


@query("revenue_bands")
def q_revenue_bands(spark, sf):
    return enriched(spark, sf).groupBy("revenue_band", "is_cross_border").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_total_usd").cast("decimal(18,2)").alias("revenue_usd"))


@query("fct_orders")
def q_fct_orders(spark, sf):
    return fct(spark, sf)


@query("fct_orders_incremental")
def q_fct_incremental(spark, sf):
    return fct_incremental(spark, sf).select("order_id", "order_date", "order_status", "order_total_usd")


@query("fct_orders_merged")
def q_fct_merged(spark, sf):
    # the target is a stored table in a real run: cut it into the shared
    # checkpoint folder once, then read the watermark and merge from it
    target = cut_lineage(fct_previous_run(spark, sf))
    merged = change.merge_upsert(target, fct_incremental(spark, sf, target), "order_id")
    return merged.select("order_id", "order_date", "order_status", "order_total_usd",
                         "recognised_revenue_usd", "lost_revenue_usd")


@query("fct_orders_merged_by_update")
def q_fct_merged_by_update(spark, sf):
    """The merge with the look-back on the update time: orders of any date that were corrected come in."""
    target = cut_lineage(fct_previous_run(spark, sf))
    since = change.read_target_watermark(target, "order_updated_at")
    updates = change.incremental_lookback(fct(spark, sf), since, column="order_updated_at")
    return change.merge_upsert(target, updates, "order_id").select(
        "order_id", "order_date", "order_status", "order_total_usd", "recognised_revenue_usd", "lost_revenue_usd")


@query("dim_customers")
def q_dim_customers(spark, sf):
    ltv = gold.compute_ltv_metrics(silver(spark, sf), LTV_AS_OF)
    return marts.dim_customers(stg_customers(spark, sf), ltv, LTV_AS_OF, AS_OF_TS)


@query("revenue_summary")
def q_revenue_summary(spark, sf):
    return marts.revenue_summary(fct(spark, sf), AS_OF_TS)


@query("revenue_rates")
def q_revenue_rates(spark, sf):
    return marts.revenue_summary(fct(spark, sf), AS_OF_TS).select(
        *marts.REVENUE_KEYS, "cancellation_rate", "high_value_order_pct", "international_order_pct")


# --- Change: SCD2 and as-of ---------------------------------------------------
def customer_history(spark, sf):
    versions = marts.stage_customers(A.customer_versions(A.load_table(spark, sf, "customer")))
    return change.scd2_from_changelog(versions)


@query("scd2_history")
def q_scd2_history(spark, sf):
    return customer_history(spark, sf).select("customer_id", "customer_tier", "valid_from", "valid_to", "scd_id")


@query("scd2_apply_step")
def q_scd2_apply(spark, sf):
    staged = marts.stage_customers(
        A.customer_versions(A.load_table(spark, sf, "customer"))
    ).withColumn("_k", F.element_at(F.split("customer_id", "-"), 2).cast("bigint"))
    first = staged.where(F.col("customer_updated_at") == F.to_timestamp(F.col("customer_created_at")))
    snapshot = change.scd2_initial(first.drop("_k"))
    latest = clean.latest_per_key(staged, "customer_id", ["customer_updated_at"])
    source = latest.where(F.col("_k") % 11 != 0).drop("_k")
    step = change.scd2_apply(snapshot, source, SNAPSHOT_RUN_TS)
    return step.select("customer_id", "customer_tier", "valid_from", "valid_to", "scd_id")


@query("tier_at_order_time")
def q_tier_at_order_time(spark, sf):
    orders = stg_orders(spark, sf).select("order_id", "customer_id", "order_created_at")
    versions = marts.stage_customers(A.customer_versions(A.load_table(spark, sf, "customer")))
    return change.as_of_join(orders, versions, "customer_id", "order_created_at",
                             valid_from="customer_updated_at", valid_to=None)


# --- Fraud features and rules -----------------------------------------------
def tx(spark, sf):
    return _stand_in(spark, sf, "transactions", lambda: A.transactions_burst(A.load_table(spark, sf, "events")))


@query("tx_velocity")
def q_tx_velocity(spark, sf):
    return features.velocity_counts(features.with_event_ts(tx(spark, sf))).select(
        "transaction_id", "card_id", "event_ts", "tx_count_1min", "tx_count_5min")


@query("tx_avg_amount_30d")
def q_tx_avg(spark, sf):
    return features.avg_amount_30d(features.with_event_ts(tx(spark, sf))).select(
        "transaction_id", "card_id", "amount_count_30d", "amount_sum_30d", "avg_amount_30d")


@query("tx_avg_amount_nightly")
def q_tx_avg_nightly(spark, sf):
    return features.nightly_avg_amount(tx(spark, sf)).select("transaction_id", "card_id", "avg_amount_nightly")


@query("tx_last_position")
def q_tx_last_position(spark, sf):
    return features.last_position(features.with_event_ts(tx(spark, sf))).select(
        "transaction_id", "card_id", "last_latitude", "last_longitude", "last_tx_timestamp")


@query("tx_device_seen")
def q_tx_device_seen(spark, sf):
    return features.device_seen(features.with_event_ts(tx(spark, sf))).select(
        "transaction_id", "device_fingerprint", "device_seen_90d")


@query("tx_category_seen")
def q_tx_category_seen(spark, sf):
    return features.category_seen(features.with_event_ts(tx(spark, sf))).select(
        "transaction_id", "merchant_category", "category_seen_30d")


@query("tx_haversine_speed")
def q_tx_speed(spark, sf):
    df = features.geo_speed(features.last_position(features.with_event_ts(tx(spark, sf))))
    return df.select(
        "transaction_id",
        F.round("distance_km", 3).alias("distance_km"),
        F.round("speed_kmh", 3).alias("speed_kmh"),
    )


def decided(spark, sf):
    feats = features.offline_features(tx(spark, sf))
    return rules.decide(rules.blocklist_flag(feats, BLOCKLISTED_MERCHANTS))


def scored(spark, sf):
    return rules.score_batch(tx(spark, sf), BLOCKLISTED_MERCHANTS, AS_OF_TS)


def _rule_query(name):
    def fn(spark, sf):
        df = rules.blocklist_flag(features.offline_features(tx(spark, sf)), BLOCKLISTED_MERCHANTS)
        return df.select("transaction_id", rules.rule_columns()[name].alias(name))
    return fn


for _rule in ["blacklisted_merchant", "velocity_1min", "velocity_5min", "amount_spike",
              "geo_impossibility", "new_device_high_amount", "unusual_merchant_category"]:
    _key = {"blacklisted_merchant": "rule_blocklist", "velocity_1min": "rule_velocity_1min",
            "velocity_5min": "rule_velocity_5min", "amount_spike": "rule_amount_spike",
            "geo_impossibility": "rule_geo", "new_device_high_amount": "rule_new_device",
            "unusual_merchant_category": "rule_category"}[_rule]
    query(_key)(_rule_query(_rule))


@query("fraud_decisions")
def q_fraud_decisions(spark, sf):
    return scored(spark, sf)


@query("fraud_alerts")
def q_fraud_alerts(spark, sf):
    return rules.alerts(scored(spark, sf)).select("transaction_id", "fraud_decision", "triggered_rules")


@query("fraud_summary")
def q_fraud_summary(spark, sf):
    return rules.fraud_summary(scored(spark, sf))


@query("fraud_rule_hits")
def q_fraud_rule_hits(spark, sf):
    return rules.rule_hits(scored(spark, sf))


@query("fraud_score_bands")
def q_fraud_score_bands(spark, sf):
    """Bands a supplied probability: the events' ``props.k`` / 100 stands in
    for the external model's score."""
    ev = A.load_table(spark, sf, "events")
    scored_ev = ev.select(
        F.concat(F.lit("TX-"), F.col("event_id").cast("string")).alias("transaction_id"),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).alias("fraud_score"),
    )
    return rules.score_bands(scored_ev).groupBy("score_band").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.round(F.min("fraud_score"), 2).alias("min_score"),
        F.round(F.max("fraud_score"), 2).alias("max_score"))


@query("offline_features")
def q_offline_features(spark, sf):
    return features.offline_features(tx(spark, sf)).select(
        "transaction_id", "tx_count_1min", "tx_count_5min", "amount_count_30d", "avg_amount_30d",
        "last_tx_timestamp", "device_seen_90d", "category_seen_30d")


@query("nightly_profile")
def q_nightly_profile(spark, sf):
    return features.nightly_profile(tx(spark, sf), PROFILE_DATE)


# --- Data quality -------------------------------------------------------------
from ordermart.functions import fixed  # noqa: E402
from ordermart.operators import quality  # noqa: E402

SILVER_SCHEMA_DDL = (
    "order_id string, customer_id string, order_status string, order_total_amount decimal(18,4), "
    "currency_code string, channel string, shipping_country string, item_count int, "
    "order_created_at timestamp, order_updated_at timestamp, order_date date, "
    "order_total_usd decimal(18,4), is_high_value boolean, order_size_tier string, is_international boolean"
)


def products(spark, sf):
    """Product catalogue stand-in from ``part``."""
    return A.load_table(spark, sf, "part").select(
        F.concat(F.lit("PRD-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"))


ORDER_SPECS = [
    {"test": "not_null", "column": "order_id"},
    {"test": "unique", "column": "order_id"},
    {"test": "not_null", "column": "customer_id"},
    {"test": "accepted_values", "column": "order_status", "values": fixed.VALID_ORDER_STATUSES},
    {"test": "not_null", "column": "order_total_usd"},
    {"test": "expression_is_true", "column": "order_total_usd", "expression": ">= 0", "name": "order_total_usd_non_negative"},
]
CUSTOMER_SPECS = [
    {"test": "not_null", "column": "customer_id"},
    {"test": "unique", "column": "customer_id"},
    {"test": "not_null", "column": "email"},
]
PRODUCT_SPECS = [
    {"test": "not_null", "column": "product_id"},
    {"test": "unique", "column": "product_id"},
]


@query("dq_suite_results")
def q_dq_suite(spark, sf):
    a = quality.suite_from_specs(silver(spark, sf), "orders", ORDER_SPECS).results(list_values=True)
    b = quality.suite_from_specs(stg_customers(spark, sf), "customers", CUSTOMER_SPECS).results()
    c = quality.suite_from_specs(products(spark, sf), "products", PRODUCT_SPECS).results()
    return a.unionByName(b).unionByName(c)


@query("dq_null_rate")
def q_dq_null_rate(spark, sf):
    return (quality.QualitySuite(silver(spark, sf), "silver_orders")
            .null_rate("shipping_country", 0.01).null_rate("item_count", 0.05).results())


@query("dq_unique")
def q_dq_unique(spark, sf):
    typed = clean.cast_and_normalise(bronze(spark, sf))
    a = quality.QualitySuite(typed, "bronze_orders").unique(["order_id"]).unique(["order_id", "order_updated_at"]).results()
    b = quality.QualitySuite(silver(spark, sf), "silver_orders").unique(["order_id"]).results()
    return a.unionByName(b)


@query("dq_accepted_values")
def q_dq_accepted(spark, sf):
    typed = clean.cast_and_normalise(bronze(spark, sf))
    return (quality.QualitySuite(typed, "bronze_orders")
            .accepted_values("order_status", fixed.VALID_ORDER_STATUSES)
            .accepted_values("channel", fixed.VALID_CHANNELS)
            .accepted_values("currency_code", list(fixed.FX_RATES_TO_USD)).results(list_values=True))


@query("dq_volume")
def q_dq_volume(spark, sf):
    return quality.volume_by_partition(bronze(spark, sf), "_ingestion_date")


@query("dq_expression")
def q_dq_expression(spark, sf):
    typed = clean.cast_and_normalise(bronze(spark, sf))
    return (quality.QualitySuite(typed, "bronze_orders")
            .expression_is_true("amount_non_negative", "order_total_amount >= 0")
            .expression_is_true("items_positive", "item_count > 0").not_empty().volume(30000, fixed.BRONZE_VOLUME_TOLERANCE)
            .results())


@query("dq_relationships")
def q_dq_relationships(spark, sf):
    cust = stg_customers(spark, sf)
    a = quality.QualitySuite(fct(spark, sf), "fct_orders").relationships("customer_id", cust, "customer_id").results()
    b = quality.QualitySuite(tx(spark, sf), "transactions").relationships("customer_id", cust, "customer_id").results()
    return a.unionByName(b)


@query("dq_freshness")
def q_dq_freshness(spark, sf):
    a = quality.source_freshness(bronze(spark, sf), "orders", "_ingested_at", AS_OF_TS)
    b = quality.source_freshness(stg_customers(spark, sf), "customers", "_ingested_at", AS_OF_TS)
    return a.unionByName(b)


@query("dq_schema")
def q_dq_schema(spark, sf):
    from pyspark.sql.types import _parse_datatype_string

    return quality.schema_conformance(silver(spark, sf).select(SILVER_COLUMNS), _parse_datatype_string(SILVER_SCHEMA_DDL))


@query("dq_layer_gate")
def q_dq_layer_gate(spark, sf):
    s = (quality.QualitySuite(silver(spark, sf), "silver_orders").not_empty()
         .no_nulls(["order_id", "customer_id", "order_date", "order_total_usd"])
         .unique(["order_id"]).accepted_values("order_status", fixed.VALID_ORDER_STATUSES))
    return s.results(list_values=True)


@query("silver_reject_accounting")
def q_silver_reject_accounting(spark, sf):
    tagged = clean.cast_and_normalise(bronze(spark, sf)).withColumn("_quarantine_reason", clean.invalid_reason())
    return quality.reject_accounting(tagged, "silver")


# --- Bronze, sinks and pipelines ---------------------------------------------
from ordermart.operators import bronze as bronze_ops  # noqa: E402
from ordermart.plans import pipelines  # noqa: E402
from ordermart.session import cut_lineage, scratch_path, stream_start  # noqa: E402
from ordermart.sinks import lake as sink  # noqa: E402
from ordermart.sources import cdc, lake  # noqa: E402

RUN_DATE, NEXT_RUN_DATE = "2001-08-02", "2001-08-03"


def land_cdc_json(spark, sf, name="landing") -> str:
    """Write the CDC JSON lines (with planted broken lines) to a fresh
    folder under the shared checkpoint root; returns its path."""
    path = scratch_path(spark, name)
    A.cdc_json_lines(_orders(spark, sf)).write.text(path)
    return path


@query("bronze_flatten")
def q_bronze_flatten(spark, sf):
    return bronze_ops.flatten_envelope(A.cdc_events(_orders(spark, sf)), RUN_DATE, AS_OF_TS)


@query("bronze_corrupt_split")
def q_bronze_corrupt_split(spark, sf):
    parsed, corrupt = cdc.split_corrupt(cdc.read_cdc_json(spark, land_cdc_json(spark, sf)))
    p = parsed.groupBy("op").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("parsed").alias("kind"), "op", "rows")
    c = corrupt.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("corrupt").alias("kind"), F.lit(None).cast("string").alias("op"), "rows")
    return p.unionByName(c)


@query("bronze_reject_accounting")
def q_bronze_reject_accounting(spark, sf):
    raw = cdc.read_cdc_json(spark, land_cdc_json(spark, sf)).persist()
    return bronze_ops.bronze_accounting(raw)


@query("pipeline_bronze_accounting")
def q_pipeline_bronze_accounting(spark, sf):
    return pipelines.bronze_written(spark, _pipeline_lake(spark, sf), RUN_DATE)


@query("pipeline_bronze_rerun")
def q_pipeline_bronze_rerun(spark, sf):
    """Two run dates, each run twice; the second date's landing (a third of the orders' kept events)
    holds no rejects. Silver of that date applies deletes."""
    root = scratch_path(spark, "lake")
    p = pipelines.LakePaths.under(root)
    third = F.col("o_orderkey") % 3 == 0
    lines = A.cdc_json_lines(_orders(spark, sf).where(third))
    kept = F.col("value").endswith("}}") & F.get_json_object("value", "$.op").isin(list(fixed.CDC_KEEP_OPS))
    landings = {RUN_DATE: A.cdc_json_lines(_orders(spark, sf).where(~third)).union(lines.where(~F.coalesce(kept, F.lit(False)))),
                NEXT_RUN_DATE: lines.where(kept)}
    for date, landed in landings.items():
        landed.write.text(f"{p.landing}/{date}")
    for date in [*landings, *landings]:
        pipelines.run_bronze(spark, p, date, AS_OF_TS, source=f"{p.landing}/{date}", trailing=0)
    pipelines.run_silver(spark, p, NEXT_RUN_DATE, deletes=True)
    runs = [pipelines.bronze_written(spark, p, date, f"{p.landing}/{date}").withColumn("run_date", F.to_date(F.lit(date)))
            for date in landings]
    return runs[0].unionByName(runs[1])


@query("pipeline_volume_history")
def q_pipeline_volume_history(spark, sf):
    """Three runs, the third with far fewer lines; each held against the mean of those before it. The runs
    are repeated, which changes nothing."""
    p = pipelines.LakePaths.under(scratch_path(spark, "lake"))
    days = [str(dt.date.fromisoformat(RUN_DATE) + dt.timedelta(days=i)) for i in range(3)]
    part = F.col("o_orderkey") % 20
    for day, of_day in zip(days, (part < 9, (part >= 9) & (part < 18), part >= 18)):
        A.cdc_json_lines(_orders(spark, sf).where(of_day)).write.text(f"{p.landing}/{day}")
    for day in [*days, *days]:
        try:
            pipelines.run_bronze(spark, p, day, AS_OF_TS, source=f"{p.landing}/{day}")
        except ValueError:  # the gate; its verdict is in the stored measures
            pass
    held = quality.volume_of_runs(pipelines.run_metrics(spark, p), tolerance=fixed.BRONZE_VOLUME_TOLERANCE)
    return held.select("layer", F.to_date("run_date").alias("run_date"), "kept_rows", "expected", "passed")


@query("sink_quarantine_corrupt")
def q_sink_quarantine_corrupt(spark, sf):
    back = spark.read.schema("_raw_record string, _quarantine_ts timestamp").json(
        _pipeline_lake(spark, sf).quarantine).drop("quarantine_date")
    return back.groupBy("_quarantine_ts").agg(F.count("*").alias("rows"))


@query("silver_older_run_after_newer")
def q_silver_older_run_after_newer(spark, sf):
    """B2: the newest versions are stored first, the first versions after; the table is that of one run."""
    root = scratch_path(spark, "silver-order")
    sink.write_silver(silver(spark, sf), root)
    older = A.bronze_rows(_orders(spark, sf)).where(F.col("_cdc_operation") == "c")
    sink.write_silver(clean.silver_orders(older)[0], root)
    return lake.read_history(spark, root).select(SILVER_COLUMNS)


@query("dq_bad_values")
def q_dq_bad_values(spark, sf):
    """All values outside a domain as rows, more than 20 of them."""
    part = A.load_table(spark, sf, "part")
    return quality.QualitySuite(part, "part").bad_values("p_brand", ["Brand#11", "Brand#22"])


@query("rule_blocklist_table")
def q_rule_blocklist_table(spark, sf):
    """E9 with the blocklist as a table."""
    blocked = tx(spark, sf).select("merchant_id").where(F.col("merchant_id").isin(BLOCKLISTED_MERCHANTS)).distinct()
    return rules.blocklist_flag(tx(spark, sf), blocked).select("transaction_id", "is_blacklisted_merchant")


@query("bronze_op_rejects")
def q_bronze_op_rejects(spark, sf):
    rej = bronze_ops.op_rejects(A.cdc_events(_orders(spark, sf)))
    return rej.groupBy("_reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@query("silver_fx_rate_table")
def q_silver_fx_rate_table(spark, sf):
    rates = spark.createDataFrame(
        [(k, v) for k, v in fixed.FX_RATES_TO_USD.items()], "currency_code string, rate_to_usd decimal(10,5)")
    valid, _ = clean.split_invalid(clean.cast_and_normalise(bronze(spark, sf)))
    return clean.fx_lookup(clean.latest_per_key(valid), rates).select(
        "order_id", "currency_code", "order_total_amount", "order_total_usd")


def _pipeline_lake(spark, sf) -> pipelines.LakePaths:
    root = scratch_path(spark, "lake")
    p = pipelines.LakePaths.under(root)
    A.cdc_json_lines(_orders(spark, sf)).write.text(p.landing)
    pipelines.run_bronze(spark, p, RUN_DATE, AS_OF_TS)
    return p


@query("sink_roundtrip_bronze")
def q_sink_roundtrip_bronze(spark, sf):
    p = _pipeline_lake(spark, sf)
    return lake.read_partition(spark, p.bronze, RUN_DATE)


@query("sink_roundtrip_silver")
def q_sink_roundtrip_silver(spark, sf):
    root = scratch_path(spark, "silver")
    first = A.bronze_rows(_orders(spark, sf)).where(F.col("_cdc_operation") == "c")
    sink.write_silver(clean.silver_orders(first)[0], root)
    sink.write_silver(silver(spark, sf), root)
    return lake.read_history(spark, root).select(SILVER_COLUMNS)


@query("sink_snapshot_latest")
def q_sink_snapshot_latest(spark, sf):
    root = scratch_path(spark, "gold")
    sink.write_snapshot_and_latest(gold.compute_ltv_metrics(silver(spark, sf), LTV_AS_OF),
                                   f"{root}/customer_ltv", f"{root}/latest", LTV_AS_OF)
    return lake.read_history(spark, f"{root}/latest")


@query("sink_quarantine")
def q_sink_quarantine(spark, sf):
    root = scratch_path(spark, "quarantine")
    _, invalid = clean.split_invalid(clean.cast_and_normalise(bronze(spark, sf)))
    sink.quarantine_invalid(invalid, root, RUN_DATE)
    back = spark.read.parquet(root)
    return back.groupBy("_quarantine_reason", "_quarantine_date").agg(F.count(F.lit(1)).alias("rows"))


@query("sink_profile")
def q_sink_profile(spark, sf):
    root = scratch_path(spark, "profile")
    sink.write_profile_features(features.nightly_profile(tx(spark, sf), PROFILE_DATE), root)
    back = spark.read.parquet(root)
    return back.select(
        "card_id",
        F.col("avg_amount_30d").cast("decimal(18,4)").alias("avg_amount_30d"),
        F.col("tx_count_30d").cast("bigint").alias("tx_count_30d"),
        F.col("last_latitude").cast("float").alias("last_latitude"),
        F.col("last_longitude").cast("float").alias("last_longitude"),
        F.col("last_tx_timestamp").cast("timestamp").alias("last_tx_timestamp"),
        F.col("devices_90d").cast("bigint").alias("devices_90d"),
        F.from_json("merchant_categories_30d", "array<string>").alias("merchant_categories_30d"),
        "expires_on",
    )


@query("sink_cluster")
def q_sink_cluster(spark, sf):
    root = scratch_path(spark, "fct")
    sink.write_clustered(fct(spark, sf), root)
    return spark.read.parquet(root).select("order_id", "order_date", "order_status", "order_total_usd", "revenue_band")


@query("sink_audit")
def q_sink_audit(spark, sf):
    root = scratch_path(spark, "audit")
    s = decided(spark, sf)
    audit = rules.score_projection(s.withColumn("processed_at", F.lit(AS_OF_TS).cast("timestamp")), AS_OF_TS)
    audit = audit.join(s.select("transaction_id", F.to_date("event_ts").alias("event_date")), "transaction_id")
    sink.write_audit(audit, root)
    return spark.read.parquet(root).select("transaction_id", "fraud_decision", "event_date")


@query("pipeline_gold")
def q_pipeline_gold(spark, sf):
    p = _pipeline_lake(spark, sf)
    pipelines.run_silver(spark, p, RUN_DATE)
    return pipelines.run_gold(spark, p, LTV_AS_OF)


@query("pipeline_marts")
def q_pipeline_marts(spark, sf):
    p = _pipeline_lake(spark, sf)
    pipelines.run_silver(spark, p, RUN_DATE)
    pipelines.run_gold(spark, p, LTV_AS_OF)
    paths = pipelines.run_marts(spark, p, A.customers_src(A.load_table(spark, sf, "customer")), LTV_AS_OF, AS_OF_TS)
    return lake.read_history(spark, paths["revenue_summary"])


@query("pipeline_snapshot")
def q_pipeline_snapshot(spark, sf):
    p = pipelines.LakePaths.under(scratch_path(spark, "snap"))
    staged = marts.stage_customers(A.customer_versions(A.load_table(spark, sf, "customer"))).withColumn(
        "_k", F.element_at(F.split("customer_id", "-"), 2).cast("bigint"))
    first = staged.where(F.col("customer_updated_at") == F.to_timestamp(F.col("customer_created_at"))).drop("_k")
    pipelines.run_snapshot(spark, p, first, SNAPSHOT_RUN_TS)
    latest = clean.latest_per_key(staged, "customer_id", ["customer_updated_at"])
    out = pipelines.run_snapshot(spark, p, latest.where(F.col("_k") % 11 != 0).drop("_k"), SNAPSHOT_RUN_TS)
    return out.select("customer_id", "customer_tier", "valid_from", "valid_to", "scd_id")


# --- Streams ------------------------------------------------------------------
from ordermart.schemas import TRANSACTION  # noqa: E402
from ordermart.streaming import outputs as stream_outputs  # noqa: E402
from ordermart.streaming import profiles as stream_profiles  # noqa: E402
from ordermart.streaming import scorer as stream_scorer  # noqa: E402
from ordermart.streaming import source as stream_source  # noqa: E402

STREAM_SLICE_DAYS = 6
REPLAY_MODULUS = 50


def _tx_with_slice(spark, sf):
    t = features.with_event_ts(tx(spark, sf))
    return t.withColumn("_slice", F.floor((F.dayofyear("event_ts") - 1) / STREAM_SLICE_DAYS).cast("int"))


def _stream_run(spark, sf, build, name):
    """Land the transactions slice by slice (JSON lines, event-time order,
    ids with id % 50 = 0 replayed in the next slice) and after each landing
    run the stream with ``availableNow`` from the same checkpoint: every
    slice is a restart from the checkpoint (J3)."""
    root = scratch_path(spark, name)
    t = _tx_with_slice(spark, sf)
    value = F.to_json(F.struct(*[F.col(f.name) for f in TRANSACTION.fields])).alias("value")
    replay = t.where(F.element_at(F.split("transaction_id", "-"), 2).cast("bigint") % REPLAY_MODULUS == 0)
    slices = [r["_slice"] for r in t.select("_slice").distinct().orderBy("_slice").collect()]
    for s in slices:
        land = t.where(F.col("_slice") == s).select(value)
        land = land.unionByName(replay.where(F.col("_slice") == s - 1).select(value))
        land.write.text(f"{root}/landing/slice={s:03d}")
        txs = stream_source.read_transactions(spark, path=f"{root}/landing/slice=*")
        with stream_start(spark, None):
            q = build(txs, root).trigger(availableNow=True).start()
            q.awaitTermination()
        if q.exception():
            raise q.exception()
    return root


ID_MEMORY = 35 * 86_400  # replays come up to two slices later


def _stored_profile(spark, sf):
    """The nightly profile tables, stored as the refresh writes them (not recomputed per micro-batch)."""
    return {n: cut_lineage(t) for n, t in stream_scorer.profile_tables(tx(spark, sf), PROFILE_DATE).items()}


def _scorer_build(spark, sf):
    profile = _stored_profile(spark, sf)

    def build(txs, root):
        scored = stream_scorer.score_stream(txs, profile, BLOCKLISTED_MERCHANTS, F.lit(AS_OF_TS).cast("timestamp"),
                                            id_memory_seconds=ID_MEMORY)
        return scored.writeStream.foreachBatch(stream_scorer.fan_out(f"{root}/out")).option(
            "checkpointLocation", f"{root}/checkpoint")
    return build


@query("stream_velocity")
def q_stream_velocity(spark, sf):
    root = _stream_run(spark, sf, _scorer_build(spark, sf), "stream-velocity")
    return stream_outputs.read_output(spark, f"{root}/out", "audit").select(
        "transaction_id", "tx_count_1min", "tx_count_5min", "last_latitude", "last_longitude", "last_tx_timestamp")


@query("stream_scored")
def q_stream_scored(spark, sf):
    root = _stream_run(spark, sf, _scorer_build(spark, sf), "stream-scored")
    stream_outputs.compact(spark, f"{root}/out", "scored")
    kv = stream_outputs.read_output(spark, f"{root}/out", "scored")
    rec = F.from_json("value", "transaction_id string, fraud_decision string, triggered_rules string, decision_reason string")
    return kv.select("key", rec.alias("r")).select("key", "r.fraud_decision", "r.triggered_rules", "r.decision_reason")


@query("stream_alerts")
def q_stream_alerts(spark, sf):
    root = _stream_run(spark, sf, _scorer_build(spark, sf), "stream-alerts")
    kv = stream_outputs.read_output(spark, f"{root}/out", "alerts")
    return kv.select("key", F.get_json_object("value", "$.fraud_decision").alias("fraud_decision"))


@query("stream_dedup")
def q_stream_dedup(spark, sf):
    root = _stream_run(spark, sf, _scorer_build(spark, sf), "stream-dedup")
    a = stream_outputs.read_output(spark, f"{root}/out", "audit")
    return a.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("transaction_id").alias("transactions"))


def _window_build(which):
    def build(txs, root):
        tumbling, sliding = stream_scorer.velocity_windows(txs, ID_MEMORY)
        df = tumbling if which == "tumbling" else sliding
        return (df.writeStream.foreachBatch(stream_scorer.write_window_counts(f"{root}/out"))
                .option("checkpointLocation", f"{root}/checkpoint"))
    return build


@query("stream_tumbling_velocity")
def q_stream_tumbling(spark, sf):
    root = _stream_run(spark, sf, _window_build("tumbling"), "stream-tumbling")
    return stream_scorer.window_totals(spark, f"{root}/out")


@query("stream_sliding_velocity")
def q_stream_sliding(spark, sf):
    root = _stream_run(spark, sf, _window_build("sliding"), "stream-sliding")
    stream_scorer.fold_windows(spark, f"{root}/out")
    return stream_scorer.window_totals(spark, f"{root}/out")


LATE_MODULUS, BROKEN_MODULUS = 37, 211


@query("stream_accounting")
def q_stream_accounting(spark, sf):
    """O6 through :func:`run_fraud_stream`: events 45 minutes late (they come
    with the second landing, after newer ones of their card), ids replayed at once
    and in the second landing, broken lines. Every line is decided once, a duplicate,
    or undecodable."""
    root = scratch_path(spark, "stream-accounting")
    t = features.with_event_ts(tx(spark, sf)).withColumn(
        "_n", F.element_at(F.split("transaction_id", "-"), 2).cast("bigint"))
    value = F.to_json(F.struct(*[F.col(f.name) for f in TRANSACTION.fields])).alias("value")
    late = F.col("_n") % LATE_MODULUS == 1
    replayed = t.where(F.col("_n") % REPLAY_MODULUS == 0)
    broken = t.where(F.col("_n") % BROKEN_MODULUS == 0).select(F.concat(F.lit("{broken "), "transaction_id").alias("value"))
    first = t.where(~late).select(value).unionByName(replayed.where(~late).select(value)).unionByName(broken)
    second = t.where(late).select(value).unionByName(replayed.select(value))
    profile = _stored_profile(spark, sf)
    for i, lines in enumerate((first, second)):
        lines.write.text(f"{root}/landing/part={i}")
        for q in stream_scorer.run_fraud_stream(
                spark, f"{root}/out", f"{root}/checkpoint", profile, BLOCKLISTED_MERCHANTS, path=f"{root}/landing/part=*",
                trigger={"availableNow": True}, processed_at=F.lit(AS_OF_TS).cast("timestamp"), id_memory_seconds=ID_MEMORY):
            q.awaitTermination()
            if q.exception():
                raise q.exception()
    audit = stream_outputs.read_output(spark, f"{root}/out", "audit")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [
        count(spark.read.text(f"{root}/landing"), "input_rows"),
        audit.agg(F.count("*").alias("decided_rows"), F.count_distinct("transaction_id").alias("transactions"),
                  F.max("is_late").alias("has_late")),
        count(stream_outputs.read_output(spark, f"{root}/out", "duplicates"), "duplicate_rows"),
        count(spark.read.schema("_raw string").json(f"{root}/out/quarantine"), "undecodable_rows")]
    one = [p.withColumn("_one", F.lit(1)) for p in parts]  # a row each
    joined = one[0]
    for other in one[1:]:
        joined = joined.join(other, "_one")
    return joined.drop("_one").withColumn(
        "balanced", F.col("input_rows") == F.col("decided_rows") + F.col("duplicate_rows") + F.col("undecodable_rows"))


@query("stream_nightly_profiles")
def q_stream_nightly_profiles(spark, sf):
    """One running query over three parts of the transactions; a night's profile is published before the
    second and the third. Every event must have the profile values of the latest night before its date (none when
    that has expired), as joined here in batch."""
    root = scratch_path(spark, "stream-nights")
    t = features.with_event_ts(tx(spark, sf)).withColumn("_d", F.to_date("event_ts"))
    lo, days = t.agg(F.min("_d"), F.date_diff(F.max("_d"), F.min("_d"))).first()
    nights = [lo + dt.timedelta(days=days * i // 3) for i in (1, 2)]
    edges = [lo - dt.timedelta(days=1), *nights, lo + dt.timedelta(days=days)]
    value = F.to_json(F.struct(*[F.col(f.name) for f in TRANSACTION.fields])).alias("value")
    store = stream_profiles.ProfileStore(spark, f"{root}/profile")
    profiles, running = {}, []
    try:
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if i:
                profiles[str(a)] = {n: cut_lineage(p) for n, p in stream_scorer.profile_tables(tx(spark, sf), str(a)).items()}
                store.publish(profiles[str(a)], str(a))
            t.where((F.col("_d") > F.lit(a)) & (F.col("_d") <= F.lit(b))).select(value).write.text(f"{root}/landing/part={i}")
            if not running:
                running += stream_scorer.run_fraud_stream(
                    spark, f"{root}/out", f"{root}/checkpoint", store, BLOCKLISTED_MERCHANTS, path=f"{root}/landing/part=*",
                    trigger={"processingTime": "0 seconds"}, processed_at=F.lit(AS_OF_TS).cast("timestamp"))
            for q in running:
                q.processAllAvailable()
    finally:
        for q in running:
            q.stop()
    got = stream_outputs.read_output(spark, f"{root}/out", "audit").select(
        "transaction_id", F.col("amount_count_30d").alias("got"))
    night = F.when(F.col("_d") > F.lit(nights[1]), F.lit(nights[1])).when(F.col("_d") > F.lit(nights[0]), F.lit(nights[0]))
    dated = t.withColumn("_night", F.when(F.date_diff("_d", night) <= fixed.PROFILE_TTL_DAYS, night))
    amounts = [p["amounts"].withColumn("_night", F.lit(n).cast("date")) for n, p in profiles.items()]
    want = dated.join(amounts[0].unionByName(amounts[1]), ["card_id", "_night"], "left").select(
        "transaction_id", F.coalesce("amount_count_30d", F.lit(0)).alias("want"), "_night")
    return want.join(got, "transaction_id", "left").agg(
        F.count("*").alias("rows"), F.count_if(F.col("want") == F.col("got")).alias("equal_rows"),
        (F.count_if(F.col("want") > 0) > 0).alias("has_profiles"), (F.count_distinct("_night") == 2).alias("both_nights"))


@query("stream_record_cap")
def q_stream_record_cap(spark, sf):
    """A5: all transactions landed at once, with a cap of a tenth of them: ten micro-batches, the same totals."""
    root = scratch_path(spark, "stream-cap")
    t = tx(spark, sf)
    cap = -(-t.count() // 10)
    value = F.to_json(F.struct(*[F.col(f.name) for f in TRANSACTION.fields])).alias("value")
    stream_source.land_capped(t.select(value), f"{root}/landing", cap)
    for q in stream_scorer.run_fraud_stream(
            spark, f"{root}/out", f"{root}/checkpoint", _stored_profile(spark, sf), BLOCKLISTED_MERCHANTS, path=f"{root}/landing/file=*",
            trigger={"availableNow": True}, max_files_per_trigger=1, processed_at=F.lit(AS_OF_TS).cast("timestamp"),
            id_memory_seconds=ID_MEMORY):
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    per = spark.read.parquet(f"{root}/out/audit").groupBy("batch_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("batches"), F.max("n").alias("largest"), F.sum("n").alias("rows"))


@query("silver_apply_deletes")
def q_silver_apply_deletes(spark, sf):
    """Silver from the CDC envelopes with delete events applied: an
    order whose latest change is a delete leaves the table."""
    events = A.cdc_events(_orders(spark, sf))
    kept = bronze_ops.flatten_envelope(events, RUN_DATE, AS_OF_TS)
    all_changes = bronze_ops.flatten_envelope(events, RUN_DATE, AS_OF_TS, keep_ops=["c", "u", "r", "d"])
    silver_cdc = clean.silver_orders(kept)[0]
    out = change.apply_deletes(silver_cdc, change.latest_deletes(all_changes))
    return out.select("order_id", "order_status", "order_total_usd")


@query("fraud_cold_card_policy")
def q_fraud_cold_card(spark, sf):
    """Decisions under both cold-card policies, counted."""
    feats = rules.blocklist_flag(features.offline_features(tx(spark, sf)), BLOCKLISTED_MERCHANTS)
    flag = rules.decide(feats).select("transaction_id", "is_cold", F.col("fraud_decision").alias("decision_flag"))
    skip = rules.decide(feats, cold_card_policy="skip").select("transaction_id", F.col("fraud_decision").alias("decision_skip"))
    return flag.join(skip, "transaction_id").groupBy("is_cold", "decision_flag", "decision_skip").agg(
        F.count(F.lit(1)).alias("transactions"))


@query("stream_equals_batch")
def q_stream_equals_batch(spark, sf):
    """Stream = batch: the stream's keyed-state features joined with the
    batch window features of the same events, per feature equality."""
    root = _stream_run(spark, sf, _scorer_build(spark, sf), "stream-eq")
    s = stream_outputs.read_output(spark, f"{root}/out", "audit").select(
        "transaction_id", *[F.col(c).alias(f"s_{c}") for c in ["tx_count_1min", "tx_count_5min", "last_tx_timestamp"]])
    b = features.offline_features(tx(spark, sf)).select("transaction_id", "tx_count_1min", "tx_count_5min", "last_tx_timestamp")
    j = b.join(s, "transaction_id", "full_outer")
    same = lambda c: F.col(c).eqNullSafe(F.col(f"s_{c}"))
    return j.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(same("tx_count_1min")).alias("equal_1min"),
        F.count_if(same("tx_count_5min")).alias("equal_5min"),
        F.count_if(same("last_tx_timestamp")).alias("equal_last_position"),
    )


@query("sink_table_stats")
def q_sink_table_stats(spark, sf):
    """The fact table saved as a catalog table and analysed; the
    catalog's row count must equal the table's."""
    import uuid

    db = f"ordermart_{uuid.uuid4().hex[:8]}"
    name = sink.save_table(fct(spark, sf), db, "fct_orders", scratch_path(spark, "catalog"), cluster_col="order_date")
    return sink.table_statistics(spark, name).select(F.lit("fct_orders").alias("table_name"), "row_count")
