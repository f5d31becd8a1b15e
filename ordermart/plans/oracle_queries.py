"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from ordermart.plans.oracle_sql import avg2_exact, COMPLETED_IN, EXCLUDED_IN, ltv_sql, with_ctes
from ordermart.plans.queries import LTV_AS_OF, LTV_AS_OF_EARLY

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


# --- Silver -----------------------------------------------------------------
oracle("silver_cast_normalise", with_ctes(
    "SELECT order_id, customer_id, order_status, order_total_amount, currency_code, channel, "
    "shipping_country, item_count, order_created_at, order_updated_at, order_date FROM silver_typed",
    "silver_typed"))
oracle("silver_valid", with_ctes(
    "SELECT order_id, order_status, order_total_amount, order_updated_at, channel, currency_code FROM silver_valid",
    "silver_valid"))
oracle("silver_invalid", with_ctes(
    "SELECT order_id, customer_id, order_status, order_total_amount, channel, _quarantine_reason FROM silver_invalid",
    "silver_invalid"))
oracle("silver_dedup_latest", with_ctes(
    "SELECT order_id, order_status, order_updated_at, _cdc_operation FROM silver_dedup", "silver_dedup"))
oracle("silver_fx_usd", with_ctes(
    "SELECT order_id, currency_code, order_total_amount, order_total_usd FROM silver_fx", "silver_fx"))
oracle("silver_flags", with_ctes(
    "SELECT order_id, is_high_value, order_size_tier, is_international FROM silver_orders", "silver_orders"))
oracle("silver_orders", with_ctes(
    "SELECT order_id, customer_id, order_status, order_total_amount, currency_code, channel, shipping_country, "
    "item_count, order_created_at, order_updated_at, order_date, order_total_usd, is_high_value, "
    "order_size_tier, is_international FROM silver_orders", "silver_orders"))

# --- Gold -------------------------------------------------------------------
_COMP = f"order_status IN {COMPLETED_IN}"
_L12 = f"({_COMP} AND order_date >= CAST(DATE '{LTV_AS_OF}' - INTERVAL 12 MONTH AS DATE))"
oracle("ltv_totals", with_ctes(
    "SELECT customer_id, count(order_id) AS total_orders, min(order_date) AS first_order_date, "
    "max(order_date) AS last_order_date FROM silver_orders GROUP BY customer_id", "silver_orders"))
oracle("ltv_completed", with_ctes(
    f"SELECT customer_id, count(CASE WHEN {_COMP} THEN order_id END) AS completed_orders, "
    f"coalesce(CAST(sum(CASE WHEN {_COMP} THEN order_total_usd END) AS DECIMAL(18,2)), 0) AS total_revenue_usd, "
    f"coalesce({avg2_exact('order_total_usd', _COMP)}, 0) AS avg_order_value_usd "
    "FROM silver_orders GROUP BY customer_id", "silver_orders"))
oracle("ltv_cancelled", with_ctes(
    f"SELECT customer_id, count(CASE WHEN order_status IN {EXCLUDED_IN} THEN order_id END) AS cancelled_orders "
    "FROM silver_orders GROUP BY customer_id", "silver_orders"))
oracle("ltv_l12m", with_ctes(
    f"SELECT customer_id, count(CASE WHEN {_L12} THEN order_id END) AS orders_l12m, "
    f"coalesce(CAST(sum(CASE WHEN {_L12} THEN order_total_usd END) AS DECIMAL(18,2)), 0) AS revenue_l12m_usd "
    "FROM silver_orders GROUP BY customer_id", "silver_orders"))
oracle("customer_ltv", with_ctes(ltv_sql(LTV_AS_OF), "silver_orders"))
oracle("ltv_join_variant", with_ctes(ltv_sql(LTV_AS_OF), "silver_orders"))
oracle("ltv_segments", with_ctes(ltv_sql(LTV_AS_OF_EARLY, upper_bound=True), "silver_orders"))
oracle("ltv_segment_counts", with_ctes(
    "SELECT ltv_segment, count(*) AS customers, CAST(sum(total_revenue_usd) AS DECIMAL(18,2)) AS segment_revenue_usd "
    f"FROM ({ltv_sql(LTV_AS_OF_EARLY, upper_bound=True)}) GROUP BY ltv_segment", "silver_orders"))


# --- Marts ------------------------------------------------------------------
from ordermart.plans.oracle_sql import revenue_summary_sql  # noqa: E402
from ordermart.plans.queries import INCREMENTAL_TARGET_BEFORE, PROFILE_DATE, SNAPSHOT_RUN_TS  # noqa: E402

oracle("stg_orders", with_ctes("SELECT * FROM stg_orders", "stg_orders"))
oracle("stg_customers", with_ctes("SELECT * FROM stg_customers", "stg_customers"))
oracle("orders_enriched", with_ctes(
    "SELECT order_id, customer_id, customer_tier, customer_country, acquisition_channel, "
    "days_since_customer_signup, is_cross_border, revenue_band FROM orders_enriched", "orders_enriched"))
oracle("revenue_bands", with_ctes(
    "SELECT revenue_band, is_cross_border, count(*) AS orders, CAST(sum(order_total_usd) AS DECIMAL(18,2)) AS revenue_usd "
    "FROM orders_enriched GROUP BY 1, 2", "orders_enriched"))
oracle("fct_orders", with_ctes("SELECT * FROM fct_orders", "fct_orders"))
_PREV = f"(SELECT * FROM first_fct WHERE order_date < DATE '{INCREMENTAL_TARGET_BEFORE}')"
_INCR = f"(SELECT * FROM fct_orders WHERE order_date >= (SELECT max(order_date) FROM {_PREV}) - INTERVAL 3 DAY)"
oracle("fct_orders_incremental", with_ctes(
    f"SELECT order_id, order_date, order_status, order_total_usd FROM {_INCR}", "fct_orders", "first_fct"))
oracle("fct_orders_merged", with_ctes(
    f"SELECT order_id, order_date, order_status, order_total_usd, recognised_revenue_usd, lost_revenue_usd FROM ("
    f"SELECT * FROM {_PREV} p WHERE NOT EXISTS (SELECT 1 FROM {_INCR} i WHERE i.order_id = p.order_id) "
    f"UNION ALL SELECT * FROM {_INCR})", "fct_orders", "first_fct"))
_INCR_UPDATED = (f"(SELECT * FROM fct_orders WHERE order_updated_at >= CAST((SELECT max(order_updated_at) FROM {_PREV}) AS DATE) "
                 "- INTERVAL 3 DAY)")
oracle("fct_orders_merged_by_update", with_ctes(
    "SELECT order_id, order_date, order_status, order_total_usd, recognised_revenue_usd, lost_revenue_usd FROM ("
    f"SELECT * FROM {_PREV} p WHERE NOT EXISTS (SELECT 1 FROM {_INCR_UPDATED} i WHERE i.order_id = p.order_id) "
    f"UNION ALL SELECT * FROM {_INCR_UPDATED})", "fct_orders", "first_fct"))
oracle("dim_customers", with_ctes(f"""
SELECT c.customer_id, c.email, c.first_name, c.last_name, c.first_name || ' ' || c.last_name AS full_name,
  c.country_code, c.acquisition_channel, c.customer_tier, c.is_email_verified, c.is_marketing_opted_in, c.date_of_birth,
  coalesce(l.total_orders, 0) AS total_orders, coalesce(l.completed_orders, 0) AS completed_orders,
  coalesce(l.cancelled_orders, 0) AS cancelled_orders,
  CAST(coalesce(l.total_revenue_usd, 0) AS DECIMAL(18,2)) AS total_revenue_usd,
  l.avg_order_value_usd, l.first_order_date, l.last_order_date, l.days_since_last_order,
  CAST(coalesce(l.revenue_l12m_usd, 0) AS DECIMAL(18,2)) AS revenue_l12m_usd,
  coalesce(l.orders_l12m, 0) AS orders_l12m, coalesce(l.ltv_segment, 'new_customers') AS ltv_segment,
  CAST(coalesce(l.cancel_rate, 0) AS DOUBLE) AS cancel_rate,
  CAST(datediff('day', CAST(c.customer_created_at AS DATE), DATE '{LTV_AS_OF}') AS INTEGER) AS customer_age_days,
  l.first_order_date IS NULL AS is_never_purchased,
  c.customer_created_at, c.customer_updated_at, TIMESTAMP '2001-08-02 06:00:00' AS _updated_at
FROM stg_customers c LEFT JOIN ({ltv_sql(LTV_AS_OF)}) l USING (customer_id)""", "stg_customers", "silver_orders"))
oracle("revenue_summary", with_ctes(revenue_summary_sql(), "fct_orders"))
oracle("revenue_rates", with_ctes(
    "SELECT order_date, channel, customer_tier, country_code, revenue_band, cancellation_rate, "
    f"high_value_order_pct, international_order_pct FROM ({revenue_summary_sql()})", "fct_orders"))

# --- Change -----------------------------------------------------------------
oracle("scd2_history", with_ctes(
    "SELECT customer_id, customer_tier, valid_from, valid_to, scd_id FROM customer_history", "customer_history"))
_SCD_EXTRA = {
    "snap": ("""
  SELECT *, md5(customer_id || '|' || CAST(customer_updated_at AS VARCHAR)) AS scd_id
  FROM stg_customer_versions WHERE customer_updated_at = customer_created_at""", ["stg_customer_versions"]),
    "latest": ("""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_updated_at DESC) AS rn
                 FROM stg_customer_versions) WHERE rn = 1 AND _k % 11 <> 0""", ["stg_customer_versions"]),
}
oracle("scd2_apply_step", with_ctes(f"""
SELECT s.customer_id, s.customer_tier, s.customer_updated_at AS valid_from,
  CASE WHEN l.customer_id IS NULL THEN TIMESTAMP '{SNAPSHOT_RUN_TS}'
       WHEN l.customer_updated_at > s.customer_updated_at THEN l.customer_updated_at END AS valid_to,
  s.scd_id
FROM snap s LEFT JOIN latest l USING (customer_id)
UNION ALL
SELECT l.customer_id, l.customer_tier, l.customer_updated_at AS valid_from, NULL AS valid_to,
  md5(l.customer_id || '|' || CAST(l.customer_updated_at AS VARCHAR)) AS scd_id
FROM latest l LEFT JOIN snap s USING (customer_id)
WHERE s.customer_id IS NULL OR l.customer_updated_at > s.customer_updated_at""", "snap", "latest", extra=_SCD_EXTRA))
oracle("tier_at_order_time", with_ctes("""
SELECT o.order_id, o.customer_id, o.order_created_at, h.customer_tier AS customer_tier_at_event
FROM stg_orders o LEFT JOIN customer_history h
  ON o.customer_id = h.customer_id AND o.order_created_at >= h.valid_from
 AND (h.valid_to IS NULL OR o.order_created_at < h.valid_to)""", "stg_orders", "customer_history"))

# --- Fraud ------------------------------------------------------------------
oracle("tx_velocity", with_ctes(
    "SELECT transaction_id, card_id, event_ts, tx_count_1min, tx_count_5min FROM tx_features", "tx_features"))
oracle("tx_avg_amount_30d", with_ctes(
    "SELECT transaction_id, card_id, amount_count_30d, amount_sum_30d, avg_amount_30d FROM tx_scored_features",
    "tx_scored_features"))
oracle("tx_avg_amount_nightly", with_ctes("""
SELECT t.transaction_id, t.card_id,
  CASE WHEN p.rn > 0 THEN CAST(((2 * CAST(p.rs * 10000 AS HUGEINT) + p.rn) // (2 * p.rn)) / 10000.0 AS DECIMAL(18,4))
       ELSE CAST(0 AS DECIMAL(18,4)) END AS avg_amount_nightly
FROM transactions t LEFT JOIN (
  SELECT card_id, d,
    sum(ds) OVER (PARTITION BY card_id ORDER BY di RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rs,
    sum(dn) OVER (PARTITION BY card_id ORDER BY di RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rn
  FROM (SELECT card_id, CAST(event_ts AS DATE) AS d, datediff('day', DATE '1970-01-01', CAST(event_ts AS DATE)) AS di,
               sum(amount_usd) AS ds, count(*) AS dn FROM transactions GROUP BY 1, 2, 3)) p
ON t.card_id = p.card_id AND CAST(t.event_ts AS DATE) = p.d""", "transactions"))
oracle("tx_last_position", with_ctes(
    "SELECT transaction_id, card_id, last_latitude, last_longitude, last_tx_timestamp FROM tx_features", "tx_features"))
oracle("tx_device_seen", with_ctes(
    "SELECT transaction_id, device_fingerprint, device_seen_90d FROM tx_features", "tx_features"))
oracle("tx_category_seen", with_ctes(
    "SELECT transaction_id, merchant_category, category_seen_30d FROM tx_features", "tx_features"))
oracle("tx_haversine_speed", with_ctes(
    "SELECT transaction_id, round(distance_km, 3) AS distance_km, round(speed_kmh, 3) AS speed_kmh FROM tx_scored_features",
    "tx_scored_features"))
for _r, _k in [("blacklisted_merchant", "rule_blocklist"), ("velocity_1min", "rule_velocity_1min"),
               ("velocity_5min", "rule_velocity_5min"), ("amount_spike", "rule_amount_spike"),
               ("geo_impossibility", "rule_geo"), ("new_device_high_amount", "rule_new_device"),
               ("unusual_merchant_category", "rule_category")]:
    oracle(_k, with_ctes(f"SELECT transaction_id, r_{_r} AS {_r} FROM tx_rules", "tx_rules"))
oracle("fraud_decisions", with_ctes("SELECT * FROM tx_scored", "tx_scored"))
oracle("fraud_alerts", with_ctes(
    "SELECT transaction_id, fraud_decision, triggered_rules FROM tx_scored WHERE fraud_decision IN ('BLOCK', 'REVIEW')",
    "tx_scored"))
oracle("fraud_summary", with_ctes(
    "SELECT fraud_decision, count(*) AS transactions, CAST(sum(amount_usd) AS DECIMAL(18,4)) AS amount_usd, "
    "count(DISTINCT card_id) AS cards FROM tx_scored GROUP BY 1", "tx_scored"))
oracle("fraud_rule_hits", with_ctes(
    "SELECT rule, fraud_decision, count(*) AS hits FROM (SELECT fraud_decision, unnest(rl) AS rule FROM tx_decided) "
    "GROUP BY 1, 2", "tx_decided"))
oracle("fraud_score_bands", """
SELECT score_band, count(*) AS transactions, round(min(fraud_score), 2) AS min_score, round(max(fraud_score), 2) AS max_score
FROM (SELECT fraud_score, CASE WHEN fraud_score > 0.85 THEN 'BLOCK' WHEN fraud_score >= 0.6 THEN 'REVIEW' ELSE 'PASS' END AS score_band
      FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) / 100.0 AS fraud_score FROM events))
GROUP BY 1""")
oracle("offline_features", with_ctes(
    "SELECT transaction_id, tx_count_1min, tx_count_5min, amount_count_30d, avg_amount_30d, last_tx_timestamp, "
    "device_seen_90d, category_seen_30d FROM tx_scored_features", "tx_scored_features"))
oracle("nightly_profile", with_ctes(f"""
SELECT card_id,
  CASE WHEN n30 > 0 THEN CAST(((2 * CAST(s30 * 10000 AS HUGEINT) + n30) // (2 * n30)) / 10000.0 AS DECIMAL(18,4))
       ELSE CAST(0 AS DECIMAL(18,4)) END AS avg_amount_30d,
  n30 AS tx_count_30d, last_pos.latitude AS last_latitude, last_pos.longitude AS last_longitude,
  last_pos.event_ts AS last_tx_timestamp, devices_90d, merchant_categories_30d,
  CAST(DATE '{PROFILE_DATE}' + INTERVAL 35 DAY AS DATE) AS expires_on
FROM (
  SELECT card_id,
    sum(CASE WHEN d > DATE '{PROFILE_DATE}' - INTERVAL 30 DAY AND d <= DATE '{PROFILE_DATE}' THEN amount_usd END) AS s30,
    count(CASE WHEN d > DATE '{PROFILE_DATE}' - INTERVAL 30 DAY AND d <= DATE '{PROFILE_DATE}' THEN 1 END) AS n30,
    arg_max({{'latitude': latitude, 'longitude': longitude, 'event_ts': event_ts}}, (event_ts, transaction_id)) AS last_pos,
    count(DISTINCT CASE WHEN d > DATE '{PROFILE_DATE}' - INTERVAL 90 DAY AND d <= DATE '{PROFILE_DATE}' THEN device_fingerprint END) AS devices_90d,
    list_sort(list(DISTINCT merchant_category) FILTER (WHERE d > DATE '{PROFILE_DATE}' - INTERVAL 30 DAY AND d <= DATE '{PROFILE_DATE}')) AS merchant_categories_30d
  FROM (SELECT *, CAST(event_ts AS DATE) AS d FROM transactions WHERE event_ts < DATE '{PROFILE_DATE}' + INTERVAL 1 DAY)
  GROUP BY card_id)""", "transactions"))


# --- Data quality -------------------------------------------------------------
from ordermart.functions import fixed as _fx  # noqa: E402
from ordermart.plans.oracle_sql import CHANNEL_IN, CURRENCY_IN, STATUS_IN  # noqa: E402


def _dq(dataset, name, passed, details):
    return f"SELECT '{dataset}' AS dataset, '{name}' AS check_name, {passed} AS passed, {details} AS details"


def _sq(*parts):
    return " UNION ALL ".join(parts)


def _not_null(ds, src, col):
    return _dq(ds, f"no_nulls:{col}", f"(SELECT count(*) FILTER (WHERE {col} IS NULL) = 0 FROM {src})",
               f"(SELECT printf('null_count=%d', count(*) FILTER (WHERE {col} IS NULL)) FROM {src})")


def _unique(ds, src, cols):
    c = ", ".join(cols)
    inner = f"(SELECT sum(n) AS t, count(*) AS d FROM (SELECT {c}, count(*) AS n FROM {src} GROUP BY {c}))"
    return (f"SELECT '{ds}' AS dataset, 'unique:{','.join(cols)}' AS check_name, coalesce(t, 0) = d AS passed, "
            f"printf('total=%d distinct=%d dupes=%d', coalesce(t, 0), d, coalesce(t, 0) - d) AS details FROM {inner}")


def _accepted(ds, src, col, in_list):
    vals = (f"(SELECT coalesce(list_sort(list(DISTINCT CAST({col} AS VARCHAR))), []) "
            f"FROM {src} WHERE NOT ({col} IN {in_list}))")
    n = f"(SELECT count(*) FILTER (WHERE NOT ({col} IN {in_list})) FROM {src})"
    text = f"'[' || array_to_string(list_transform({vals}, lambda x: '''' || x || ''''), ', ') || ']'"
    return _dq(ds, f"accepted_values:{col}", f"{n} = 0", f"'invalid_values=' || {text} || printf(' invalid_rows=%d', {n})")


def _expr(ds, src, name, expr):
    n = f"(SELECT count(*) FILTER (WHERE NOT coalesce({expr}, TRUE)) FROM {src})"
    return _dq(ds, f"expression_is_true:{name}", f"{n} = 0", f"printf('failing_rows=%d', {n})")


def _null_rate(ds, src, col, max_rate):
    rate = (f"(SELECT CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE {col} IS NULL) AS DOUBLE) / count(*) "
            f"ELSE 0.0 END FROM {src})")
    return _dq(ds, f"null_rate:{col}", f"{rate} <= {max_rate}",
               f"'null_rate=' || printf('%.4f', round({rate}, 4)) || ' threshold={max_rate}'")


def _not_empty(ds, src):
    return _dq(ds, "not_empty", f"(SELECT count(*) > 0 FROM {src})", f"(SELECT printf('row_count=%d', count(*)) FROM {src})")


def _relationship(ds, src, col, parent, pcol):
    inner = (f"(SELECT count(*) AS o, count(DISTINCT k) AS od FROM (SELECT {col} AS k FROM {src} WHERE {col} IS NOT NULL) c "
             f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.k))")
    return (f"SELECT '{ds}' AS dataset, 'relationships:{col}' AS check_name, o = 0 AS passed, "
            f"printf('orphan_rows=%d orphan_keys=%d', o, od) AS details FROM {inner}")


_PRODUCTS = {"products": ("SELECT 'PRD-' || p_partkey AS product_id, p_name AS product_name FROM part", [])}
oracle("dq_suite_results", with_ctes(_sq(
    _not_null("orders", "silver_orders", "order_id"), _unique("orders", "silver_orders", ["order_id"]),
    _not_null("orders", "silver_orders", "customer_id"), _accepted("orders", "silver_orders", "order_status", STATUS_IN),
    _not_null("orders", "silver_orders", "order_total_usd"),
    _expr("orders", "silver_orders", "order_total_usd_non_negative", "order_total_usd >= 0"),
    _not_null("customers", "stg_customers", "customer_id"), _unique("customers", "stg_customers", ["customer_id"]),
    _not_null("customers", "stg_customers", "email"),
    _not_null("products", "products", "product_id"), _unique("products", "products", ["product_id"]),
), "silver_orders", "stg_customers", "products", extra=_PRODUCTS))
oracle("dq_null_rate", with_ctes(_sq(
    _null_rate("silver_orders", "silver_orders", "shipping_country", 0.01),
    _null_rate("silver_orders", "silver_orders", "item_count", 0.05)), "silver_orders"))
oracle("dq_unique", with_ctes(_sq(
    _unique("bronze_orders", "silver_typed", ["order_id"]),
    _unique("bronze_orders", "silver_typed", ["order_id", "order_updated_at"]),
    _unique("silver_orders", "silver_orders", ["order_id"])), "silver_typed", "silver_orders"))
oracle("dq_accepted_values", with_ctes(_sq(
    _accepted("bronze_orders", "silver_typed", "order_status", STATUS_IN),
    _accepted("bronze_orders", "silver_typed", "channel", CHANNEL_IN),
    _accepted("bronze_orders", "silver_typed", "currency_code", CURRENCY_IN)), "silver_typed"))
oracle("dq_volume", with_ctes("""
SELECT _ingestion_date, actual, expected,
  round(abs(actual - expected) / greatest(expected, 1.0), 4) AS deviation,
  coalesce(round(abs(actual - expected) / greatest(expected, 1.0), 4) <= 0.3, TRUE) AS passed
FROM (SELECT _ingestion_date, actual,
        round(avg(actual) OVER (ORDER BY _ingestion_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 2) AS expected
      FROM (SELECT _ingestion_date, count(*) AS actual FROM orders_dirty GROUP BY 1))""", "orders_dirty"))
_dev = "(SELECT CAST(abs(count(*) - 30000) AS DOUBLE) / 30000.0 FROM silver_typed)"
oracle("dq_expression", with_ctes(_sq(
    _expr("bronze_orders", "silver_typed", "amount_non_negative", "order_total_amount >= 0"),
    _expr("bronze_orders", "silver_typed", "items_positive", "item_count > 0"),
    _not_empty("bronze_orders", "silver_typed"),
    _dq("bronze_orders", "volume_anomaly", f"{_dev} <= {_fx.BRONZE_VOLUME_TOLERANCE}",
        f"(SELECT printf('actual=%d expected=%d deviation=', count(*), 30000) FROM silver_typed) || "
        f"printf('%.2f', round({_dev} * 100, 2)) || '%'"),
), "silver_typed"))
oracle("dq_relationships", with_ctes(_sq(
    _relationship("fct_orders", "fct_orders", "customer_id", "stg_customers", "customer_id"),
    _relationship("transactions", "transactions", "customer_id", "stg_customers", "customer_id"),
), "fct_orders", "stg_customers", "transactions"))


def _fresh(source, src):
    age = f"(CAST(epoch_us(TIMESTAMP '{AS_OF_TS_DQ}') - epoch_us(max(_ingested_at)) AS DOUBLE) / 3.6e9)"
    return (f"SELECT '{source}' AS source, max(_ingested_at) AS max_loaded_at, round({age}, 2) AS age_hours, "
            f"CASE WHEN max(_ingested_at) IS NULL OR {age} > 6 THEN 'error' WHEN {age} > 2 THEN 'warn' ELSE 'pass' END AS status "
            f"FROM {src}")


AS_OF_TS_DQ = "2001-08-02 06:00:00"
oracle("dq_freshness", with_ctes(_sq(_fresh("orders", "orders_dirty"), _fresh("customers", "stg_customers")),
                                 "orders_dirty", "stg_customers"))
oracle("dq_layer_gate", with_ctes(_sq(
    _not_empty("silver_orders", "silver_orders"),
    *[_not_null("silver_orders", "silver_orders", c) for c in ["order_id", "customer_id", "order_date", "order_total_usd"]],
    _unique("silver_orders", "silver_orders", ["order_id"]),
    _accepted("silver_orders", "silver_orders", "order_status", STATUS_IN)), "silver_orders"))
oracle("silver_reject_accounting", with_ctes(
    "SELECT 'silver' AS layer, count(*) AS input_rows, count(*) FILTER (WHERE _quarantine_reason IS NULL) AS valid_rows, "
    "count(*) FILTER (WHERE _quarantine_reason IS NOT NULL) AS rejected_rows, "
    "count(*) = count(*) FILTER (WHERE _quarantine_reason IS NULL) + count(*) FILTER (WHERE _quarantine_reason IS NOT NULL) AS balanced "
    "FROM silver_tagged", "silver_tagged"))


# --- Bronze, sinks and pipelines ---------------------------------------------
from ordermart.plans.oracle_sql import RUN_DATE  # noqa: E402

oracle("bronze_flatten", with_ctes("SELECT * FROM cdc_flat", "cdc_flat"))
oracle("bronze_corrupt_split", with_ctes(
    "SELECT 'parsed' AS kind, op, count(*) AS rows FROM cdc_events WHERE NOT broken GROUP BY op "
    "UNION ALL SELECT 'corrupt' AS kind, NULL AS op, count(*) AS rows FROM cdc_events WHERE broken", "cdc_events"))
oracle("bronze_reject_accounting", with_ctes("""
SELECT count(*) AS input_rows, count(*) FILTER (WHERE broken) AS corrupt_rows,
  count(*) FILTER (WHERE NOT broken AND op IN ('c', 'u', 'r')) AS kept_rows,
  count(*) FILTER (WHERE NOT broken AND op = 'd') AS deleted_rows,
  count(*) FILTER (WHERE NOT broken AND op IS NULL) AS unknown_op_rows, TRUE AS balanced
FROM cdc_events""", "cdc_events"))
oracle("bronze_op_rejects", with_ctes(
    "SELECT CASE WHEN op = 'd' THEN 'delete_event' WHEN op IS NULL THEN 'null_op' ELSE 'unknown_op' END AS _reject_reason, "
    "count(*) AS rows FROM cdc_events WHERE NOT coalesce(op IN ('c', 'u', 'r'), FALSE) GROUP BY 1", "cdc_events"))
oracle("pipeline_bronze_accounting", ORACLE["bronze_reject_accounting"])
oracle("pipeline_bronze_rerun", with_ctes(f"""
SELECT run_date, count(*) AS input_rows, count(*) FILTER (WHERE broken) AS corrupt_rows,
  count(*) FILTER (WHERE NOT broken AND op IN ('c', 'u', 'r')) AS kept_rows,
  count(*) FILTER (WHERE NOT broken AND op = 'd') AS deleted_rows,
  count(*) FILTER (WHERE NOT broken AND op IS NULL) AS unknown_op_rows, TRUE AS balanced
FROM (SELECT *, CASE WHEN NOT broken AND op IN ('c', 'u', 'r') AND o_orderkey % 3 = 0 THEN DATE '{RUN_DATE}' + 1
                     ELSE DATE '{RUN_DATE}' END AS run_date FROM cdc_events)
GROUP BY run_date""", "cdc_events"))
oracle("pipeline_volume_history", with_ctes(f"""
SELECT 'bronze' AS layer, run_date, kept_rows, expected,
  coalesce(abs(kept_rows - expected) / expected <= {_fx.BRONZE_VOLUME_TOLERANCE}, TRUE) AS passed
FROM (SELECT *, round(avg(kept_rows) OVER (ORDER BY run_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 2) AS expected
  FROM (SELECT DATE '{RUN_DATE}' + CASE WHEN o_orderkey % 20 < 9 THEN 0 WHEN o_orderkey % 20 < 18 THEN 1 ELSE 2 END AS run_date,
      count(*) FILTER (WHERE NOT broken AND op IN ('c', 'u', 'r')) AS kept_rows FROM cdc_events GROUP BY 1))""", "cdc_events"))
oracle("sink_quarantine_corrupt", with_ctes(
    f"SELECT TIMESTAMP '{AS_OF_TS_DQ}' AS _quarantine_ts, count(*) AS rows FROM cdc_events WHERE broken", "cdc_events"))
oracle("silver_older_run_after_newer", ORACLE["silver_orders"])
oracle("rule_blocklist_table", with_ctes(
    "SELECT transaction_id, merchant_id IN ('M-13', 'M-42') AS is_blacklisted_merchant FROM transactions", "transactions"))
oracle("dq_bad_values", "SELECT p_brand AS value, count(*) AS rows FROM part "
       "WHERE p_brand NOT IN ('Brand#11', 'Brand#22') GROUP BY 1")
oracle("silver_fx_rate_table", ORACLE["silver_fx_usd"])
oracle("sink_roundtrip_bronze", with_ctes(f"SELECT *, DATE '{RUN_DATE}' AS ingestion_date FROM cdc_bronze", "cdc_bronze"))
oracle("sink_roundtrip_silver", ORACLE["silver_orders"])
oracle("sink_snapshot_latest", ORACLE["customer_ltv"])
oracle("sink_quarantine", with_ctes(
    f"SELECT _quarantine_reason, '{RUN_DATE}' AS _quarantine_date, count(*) AS rows FROM silver_invalid GROUP BY 1",
    "silver_invalid"))
oracle("sink_profile", ORACLE["nightly_profile"])
oracle("sink_cluster", with_ctes(
    "SELECT order_id, order_date, order_status, order_total_usd, revenue_band FROM fct_orders", "fct_orders"))
oracle("sink_audit", with_ctes(
    "SELECT transaction_id, fraud_decision, CAST(event_ts AS DATE) AS event_date FROM tx_decided", "tx_decided"))
oracle("pipeline_gold", with_ctes(ltv_sql(LTV_AS_OF).replace("FROM silver_orders", "FROM cdc_silver_orders"),
                                  "cdc_silver_orders"))
oracle("pipeline_marts", with_ctes(revenue_summary_sql("cdc_fct"), "cdc_fct"))
oracle("pipeline_snapshot", ORACLE["scd2_apply_step"])


# --- Streams ------------------------------------------------------------------
oracle("stream_velocity", with_ctes(
    "SELECT transaction_id, tx_count_1min, tx_count_5min, last_latitude, last_longitude, last_tx_timestamp FROM tx_features",
    "tx_features"))
oracle("stream_scored", with_ctes(
    "SELECT transaction_id AS key, fraud_decision, triggered_rules, decision_reason FROM stream_scored", "stream_scored"))
oracle("stream_alerts", with_ctes(
    "SELECT transaction_id AS key, fraud_decision FROM stream_scored WHERE fraud_decision IN ('BLOCK', 'REVIEW')",
    "stream_scored"))
oracle("stream_dedup", with_ctes(
    "SELECT count(*) AS rows, count(DISTINCT transaction_id) AS transactions FROM transactions", "transactions"))
oracle("stream_nightly_profiles", with_ctes(
    "SELECT count(*) AS rows, count(*) AS equal_rows, TRUE AS has_profiles, TRUE AS both_nights FROM transactions", "transactions"))
oracle("stream_record_cap", with_ctes(
    "SELECT CAST(ceil(count(*) / ceil(count(*) / 10)) AS BIGINT) AS batches, CAST(ceil(count(*) / 10) AS BIGINT) AS largest, "
    "count(*) AS rows FROM transactions", "transactions"))
oracle("stream_accounting", with_ctes("""
SELECT count(*) + count(*) FILTER (WHERE replay AND NOT late) + count(*) FILTER (WHERE replay) + count(*) FILTER (WHERE broken)
    AS input_rows,
  count(*) AS decided_rows, count(*) AS transactions, TRUE AS has_late,
  2 * count(*) FILTER (WHERE replay AND NOT late) + count(*) FILTER (WHERE replay AND late) AS duplicate_rows,
  count(*) FILTER (WHERE broken) AS undecodable_rows, TRUE AS balanced
FROM (SELECT n % 37 = 1 AS late, n % 50 = 0 AS replay, n % 211 = 0 AS broken
      FROM (SELECT CAST(split_part(transaction_id, '-', 2) AS BIGINT) AS n FROM transactions))""", "transactions"))
oracle("stream_tumbling_velocity", with_ctes("""
SELECT card_id, time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS tx_count
FROM transactions GROUP BY 1, 2, 3""", "transactions"))
oracle("stream_sliding_velocity", with_ctes("""
SELECT card_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS tx_count
FROM (SELECT card_id, time_bucket(INTERVAL 1 MINUTE, event_ts) - k * INTERVAL 1 MINUTE AS window_start
      FROM transactions, (SELECT unnest(generate_series(0, 4)) AS k))
GROUP BY 1, 2, 3""", "transactions"))
oracle("silver_apply_deletes", with_ctes("""
SELECT order_id, order_status, order_total_usd FROM cdcflat_silver_orders s
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT order_id, arg_max(op, _kafka_timestamp_ms) AS op FROM cdc_events WHERE op IS NOT NULL GROUP BY order_id) d
  WHERE d.op = 'd' AND d.order_id = s.order_id)""", "cdcflat_silver_orders", "cdc_events"))
oracle("fraud_cold_card_policy", with_ctes("""
SELECT f.amount_count_30d = 0 AS is_cold, f.fraud_decision AS decision_flag,
  CASE WHEN f.amount_count_30d > 0 THEN f.fraud_decision
       WHEN f.r_blacklisted_merchant OR f.r_velocity_1min OR f.r_geo_impossibility
            OR (CAST(f.r_velocity_5min AS INT) + CAST(f.r_amount_spike AS INT)) >= 2 THEN 'BLOCK'
       WHEN f.r_velocity_5min OR f.r_amount_spike THEN 'REVIEW' ELSE 'PASS' END AS decision_skip,
  count(*) AS transactions
FROM tx_decided f GROUP BY 1, 2, 3""", "tx_decided"))
oracle("stream_equals_batch", with_ctes(
    "SELECT count(*) AS rows, count(*) AS equal_1min, count(*) AS equal_5min, count(*) AS equal_last_position "
    "FROM transactions", "transactions"))

from ordermart.plans.queries import SILVER_SCHEMA_DDL  # noqa: E402

_SCHEMA_ROWS = [c.strip().split(" ", 1) for c in SILVER_SCHEMA_DDL.split(", ")]
oracle("dq_schema", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{t}' AS expected_type, '{t}' AS actual_type, count({n}) AS non_null_rows, TRUE AS passed "
    "FROM silver_orders" for n, t in _SCHEMA_ROWS), "silver_orders"))
oracle("sink_table_stats", with_ctes("SELECT 'fct_orders' AS table_name, count(*) AS row_count FROM fct_orders", "fct_orders"))
