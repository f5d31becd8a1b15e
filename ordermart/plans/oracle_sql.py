"""Oracle SQL (DuckDB dialect) for the driver's correctness check.

Each query in ``__spark_entry__.queries()`` has an independent SQL statement
here that states the expected result the simple way (plain windows, plain
joins), against the same driver tables. Adapters are rebuilt as CTEs from the
same fixed spellings, so both engines see identical inputs.

Money averages: DuckDB's ``avg(decimal)`` returns DOUBLE, while Spark keeps
the exact decimal and rounds half-up; :func:`avg2_exact` reproduces Spark's
result with integer arithmetic so that ties (e.g. x.xx5) agree.
"""

from __future__ import annotations

from ordermart.functions import fixed
from ordermart.sources import adapters as A


def _lit_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _in_list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


def avg2_exact(value: str, cond: str = "TRUE") -> str:
    """Half-up average to 2 places of a decimal(18,4) expression over the rows
    where ``cond`` holds; NULL when no row matches (like ``avg``)."""
    s4 = f"sum(CASE WHEN {cond} THEN CAST({value} * 10000 AS HUGEINT) END)"
    n = f"count(CASE WHEN {cond} THEN {value} END)"
    return (
        f"CASE WHEN {n} = 0 THEN NULL ELSE CAST((CASE WHEN {s4} >= 0 "
        f"THEN (2 * {s4} + 100 * {n}) // (200 * {n}) "
        f"ELSE -((-2 * {s4} + 100 * {n}) // (200 * {n})) END) / 100.0 AS DECIMAL(18,2)) END"
    )


def avg4_exact(value: str, cond: str = "TRUE") -> str:
    """Half-up average to 4 places of a decimal(18,4) expression."""
    s4 = f"sum(CASE WHEN {cond} THEN CAST({value} * 10000 AS HUGEINT) END)"
    n = f"count(CASE WHEN {cond} THEN {value} END)"
    return (
        f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(((2 * {s4} + {n}) // (2 * {n})) / 10000.0 AS DECIMAL(18,4)) END"
    )


STATUS_IN = _in_list(fixed.VALID_ORDER_STATUSES)
CHANNEL_IN = _in_list(fixed.VALID_CHANNELS)
CURRENCY_IN = _in_list(list(fixed.FX_RATES_TO_USD))
COMPLETED_IN = _in_list(fixed.COMPLETED_STATUSES)
EXCLUDED_IN = _in_list(fixed.EXCLUDED_STATUSES)
FX_CASE = "CASE {c} " + " ".join(
    f"WHEN '{k}' THEN CAST({v} AS DECIMAL(10,5))" for k, v in fixed.FX_RATES_TO_USD.items()
) + " END"
TS_TEXT = "strftime({t}, '%Y-%m-%dT%H:%M:%S') || '.000Z'"
TS_PARSE = "try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')"
SIZE_TIER_SQL = (
    "CASE WHEN {c} = 1 THEN 'single_item' WHEN {c} <= 5 THEN 'small_basket' "
    "WHEN {c} <= 20 THEN 'medium_basket' ELSE 'large_basket' END"
)
BAND_SQL = (
    "CASE WHEN {c} < 25 THEN 'micro' WHEN {c} < 100 THEN 'small' WHEN {c} < 500 THEN 'medium' "
    "WHEN {c} < 2000 THEN 'large' ELSE 'enterprise' END"
)

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (sql, deps)


cte("ov_base", [], """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       unnest(generate_series(1, o_orderkey % 3 + 1)) AS v
FROM orders""")

cte("orders_versions", ["ov_base"], f"""
SELECT o_orderkey, v AS _version,
  'ORD-' || o_orderkey AS order_id,
  'CUST-' || o_custkey AS customer_id,
  ({_lit_list(A.STATUS_SPELLINGS)})[((o_orderkey + v) % 8) + 1] AS order_status,
  CAST(CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.005 AS DECIMAL(3,3)), 4) AS DECIMAL(18,4)) AS VARCHAR) AS order_total_amount,
  ({_lit_list(A.CURRENCY_SPELLINGS)})[(o_orderkey % 6) + 1] AS currency_code,
  ({_lit_list(A.CHANNEL_SPELLINGS)})[(o_custkey % 5) + 1] AS channel,
  {TS_TEXT.format(t="o_orderdate + to_seconds(o_orderkey % 86400)")} AS created_at,
  {TS_TEXT.format(t="o_orderdate + to_seconds(o_orderkey % 86400 + v * 3600)")} AS updated_at,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL
       WHEN o_orderkey % 9 = 0 THEN '  ' || lower(({_lit_list(A.COUNTRY_CODES)})[((o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END) % 8) + 1]) || ' '
       ELSE ({_lit_list(A.COUNTRY_CODES)})[((o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END) % 8) + 1] END AS shipping_country,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(o_orderkey % 30 + 1 AS VARCHAR) END AS item_count,
  CASE WHEN v = 1 THEN 'c' ELSE 'u' END AS _cdc_operation,
  CAST(epoch(o_orderdate + to_seconds(o_orderkey % 86400 + v * 3600)) * 1000 AS BIGINT)::VARCHAR AS _kafka_timestamp_ms,
  strftime(o_orderdate + to_seconds(o_orderkey % 86400 + v * 3600), '%Y-%m-%d') AS _ingestion_date,
  o_orderdate + to_seconds(o_orderkey % 86400 + v * 3600 + 1800) AS _ingested_at,
  'orders-cdc-s3-sink' AS _source_system
FROM ov_base""")

cte("orders_dirty", ["orders_versions"], """
SELECT o_orderkey, _version,
  CASE WHEN _slot = 1 THEN NULL ELSE order_id END AS order_id,
  CASE WHEN _slot = 9 THEN NULL ELSE customer_id END AS customer_id,
  CASE WHEN _slot = 4 THEN 'lost' WHEN _slot = 5 THEN NULL ELSE order_status END AS order_status,
  CASE WHEN _slot = 2 THEN '-' || order_total_amount WHEN _slot = 3 THEN 'N/A' ELSE order_total_amount END AS order_total_amount,
  CASE WHEN _slot = 8 THEN 'JPY' ELSE currency_code END AS currency_code,
  CASE WHEN _slot = 6 THEN 'fax' WHEN _slot = 10 THEN NULL ELSE channel END AS channel,
  CASE WHEN _slot = 7 THEN 'not-a-date' ELSE created_at END AS created_at,
  updated_at, shipping_country, item_count, _cdc_operation, _kafka_timestamp_ms,
  _ingestion_date, _ingested_at, _source_system
FROM (SELECT *, CASE WHEN _version = 1 THEN o_orderkey % 101 ELSE -1 END AS _slot FROM orders_versions)""")

_TYPED_COLS = f"""
  order_id, customer_id,
  TRY_CAST(order_total_amount AS DECIMAL(18,4)) AS order_total_amount,
  TRY_CAST(item_count AS INTEGER) AS item_count,
  {TS_PARSE.format(c="created_at")} AS order_created_at,
  {TS_PARSE.format(c="updated_at")} AS order_updated_at,
  CAST({TS_PARSE.format(c="created_at")} AS DATE) AS order_date,
  lower(trim(order_status)) AS order_status,
  lower(trim(channel)) AS channel,
  upper(trim(shipping_country)) AS shipping_country,
  upper(trim(currency_code)) AS currency_code,
  _cdc_operation, _kafka_timestamp_ms, _ingestion_date, _ingested_at, _source_system"""

REASON_SQL = f"""CASE
  WHEN order_id IS NULL THEN 'null_order_id'
  WHEN customer_id IS NULL THEN 'null_customer_id'
  WHEN order_total_amount IS NULL THEN 'null_or_unparsable_amount'
  WHEN order_total_amount < 0 THEN 'negative_amount'
  WHEN NOT coalesce(order_status IN {STATUS_IN}, FALSE) THEN 'unknown_status'
  WHEN NOT coalesce(channel IN {CHANNEL_IN}, FALSE) THEN 'unknown_channel'
  WHEN order_date IS NULL THEN 'unparsable_created_at'
  WHEN NOT coalesce(currency_code IN {CURRENCY_IN}, FALSE) THEN 'unknown_currency'
END"""


def silver_chain(prefix: str, source: str) -> None:
    """Register the Silver chain CTEs ``{prefix}typed`` .. ``{prefix}orders``
    over the bronze-shaped CTE ``source``."""
    p = prefix
    cte(f"{p}typed", [source], f"SELECT {_TYPED_COLS} FROM {source}")
    cte(f"{p}tagged", [f"{p}typed"], f"SELECT *, {REASON_SQL} AS _quarantine_reason FROM {p}typed")
    cte(f"{p}valid", [f"{p}tagged"], f"SELECT * EXCLUDE (_quarantine_reason) FROM {p}tagged WHERE _quarantine_reason IS NULL")
    cte(f"{p}invalid", [f"{p}tagged"], f"SELECT * FROM {p}tagged WHERE _quarantine_reason IS NOT NULL")
    cte(f"{p}dedup", [f"{p}valid"], f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_updated_at DESC NULLS LAST,
    _kafka_timestamp_ms DESC NULLS LAST, order_status DESC NULLS LAST) AS _rn
  FROM {p}valid) WHERE _rn = 1""")
    cte(f"{p}fx", [f"{p}dedup"], f"""
SELECT *, CAST(round(order_total_amount * {FX_CASE.format(c="currency_code")}, 4) AS DECIMAL(18,4)) AS order_total_usd
FROM {p}dedup""")
    cte(f"{p}orders", [f"{p}fx"], f"""
SELECT *,
  coalesce(order_total_usd >= 500, FALSE) AS is_high_value,
  {SIZE_TIER_SQL.format(c="item_count")} AS order_size_tier,
  NOT (shipping_country IN ('US', 'USA')) AS is_international
FROM {p}fx""")


silver_chain("silver_", "orders_dirty")
cte("first_dirty", ["orders_dirty"], "SELECT * FROM orders_dirty WHERE _cdc_operation = 'c'")
silver_chain("first_silver_", "first_dirty")


def ltv_sql(as_of: str, upper_bound: bool = False) -> str:
    cutoff = f"CAST(DATE '{as_of}' - INTERVAL 12 MONTH AS DATE)"
    comp = f"order_status IN {COMPLETED_IN}"
    l12 = f"({comp} AND order_date >= {cutoff}"
    l12 += f" AND order_date <= DATE '{as_of}')" if upper_bound else ")"
    return f"""
SELECT *,
  CASE
    WHEN revenue_l12m_usd >= 1000 AND days_since_last_order <= 30 AND cancel_rate < 0.1 THEN 'champions'
    WHEN orders_l12m >= 4 AND revenue_l12m_usd >= 300 THEN 'loyal'
    WHEN total_revenue_usd >= 500 AND days_since_last_order > 180 THEN 'at_risk'
    WHEN days_since_last_order <= 90 THEN 'new_customers'
    ELSE 'low_value' END AS ltv_segment
FROM (
  SELECT customer_id,
    count(order_id) AS total_orders,
    min(order_date) AS first_order_date,
    max(order_date) AS last_order_date,
    count(CASE WHEN {comp} THEN order_id END) AS completed_orders,
    coalesce(CAST(sum(CASE WHEN {comp} THEN order_total_usd END) AS DECIMAL(18,2)), 0) AS total_revenue_usd,
    coalesce({avg2_exact("order_total_usd", comp)}, 0) AS avg_order_value_usd,
    count(CASE WHEN order_status IN {EXCLUDED_IN} THEN order_id END) AS cancelled_orders,
    count(CASE WHEN {l12} THEN order_id END) AS orders_l12m,
    coalesce(CAST(sum(CASE WHEN {l12} THEN order_total_usd END) AS DECIMAL(18,2)), 0) AS revenue_l12m_usd,
    CAST(datediff('day', max(order_date), DATE '{as_of}') AS INTEGER) AS days_since_last_order,
    round(CAST(count(CASE WHEN order_status IN {EXCLUDED_IN} THEN order_id END) AS DOUBLE)
          / CAST(greatest(count(order_id), 1) AS DOUBLE), 4) AS cancel_rate
  FROM silver_orders GROUP BY customer_id)"""


def with_ctes(final_sql: str, *needs: str, extra: dict[str, tuple[str, list[str]]] | None = None) -> str:
    """Prefix ``final_sql`` with the CTEs it needs, in dependency order."""
    table = dict(CTES)
    table.update(extra or {})
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in table[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({table[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


# --- customers --------------------------------------------------------------
_TIER_CASE = "coalesce(CASE c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in A.SEGMENT_TIERS.items()) + " END, 'bronze')"
_COUNTRY_K = f"({_lit_list(A.COUNTRY_CODES)})[(c_custkey % 8) + 1]"

cte("customers_src", [], f"""
SELECT 'CUST-' || c_custkey AS customer_id,
  '  ' || upper(c_name) || '@Example.COM ' AS email,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'Name' || (c_custkey % 97) END AS first_name,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Family' || (c_custkey % 89) END AS last_name,
  CASE WHEN c_custkey % 3 = 0 THEN ' ' || lower({_COUNTRY_K}) ELSE {_COUNTRY_K} END AS country_code,
  ({_lit_list(A.ACQUISITION_SPELLINGS)})[(c_nationkey % 4) + 1] AS acquisition_channel,
  {_TIER_CASE} AS customer_tier,
  CASE WHEN c_custkey % 3 = 0 THEN 'false' ELSE 'true' END AS is_email_verified,
  CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS is_marketing_opted_in,
  CAST(DATE '{A.CUSTOMER_CREATED_BASE}' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) || ' 08:00:00' AS created_at,
  CAST(DATE '{A.CUSTOMER_CREATED_BASE}' + CAST(c_custkey % 365 + c_custkey % 1000 AS INTEGER) AS VARCHAR) || ' 09:30:00' AS updated_at,
  CAST(DATE '{A.DATE_OF_BIRTH_BASE}' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS VARCHAR) AS date_of_birth,
  TIMESTAMP '{A.CUSTOMER_INGESTED_AT}' AS _ingested_at,
  c_custkey AS _k
FROM customer""")

_STG_CUST = """
  customer_id, lower(trim(email)) AS email,
  coalesce(first_name, 'Unknown') AS first_name, coalesce(last_name, '') AS last_name,
  upper(trim(country_code)) AS country_code, lower(trim(acquisition_channel)) AS acquisition_channel,
  customer_tier, CAST(is_email_verified AS BOOLEAN) AS is_email_verified,
  CAST(is_marketing_opted_in AS BOOLEAN) AS is_marketing_opted_in,
  CAST(created_at AS TIMESTAMP) AS customer_created_at, CAST(updated_at AS TIMESTAMP) AS customer_updated_at,
  CAST(date_of_birth AS DATE) AS date_of_birth, _ingested_at"""
cte("stg_customers", ["customers_src"], f"SELECT {_STG_CUST} FROM customers_src")

cte("customer_versions", ["customers_src"], f"""
SELECT customer_id, email, first_name, last_name, country_code, acquisition_channel,
  ({_lit_list(A.TIER_ROTATION)})[((_k + v) % 4) + 1] AS customer_tier,
  is_email_verified, is_marketing_opted_in, date_of_birth, created_at,
  strftime(CAST(created_at AS TIMESTAMP) + to_days(CAST((v - 1) * 400 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS updated_at,
  _ingested_at, _k, v AS _version
FROM (SELECT *, unnest(generate_series(1, _k % 3 + 1)) AS v FROM customers_src)""")
cte("stg_customer_versions", ["customer_versions"], f"SELECT {_STG_CUST}, _k FROM customer_versions")
cte("customer_history", ["stg_customer_versions"], """
SELECT *, md5(customer_id || '|' || CAST(customer_updated_at AS VARCHAR)) AS scd_id,
  customer_updated_at AS valid_from,
  lead(customer_updated_at) OVER (PARTITION BY customer_id ORDER BY customer_updated_at) AS valid_to
FROM stg_customer_versions""")


# --- marts ------------------------------------------------------------------
def stg_orders_cte(name: str, silver: str) -> None:
    cte(name, [silver], f"""
SELECT order_id, customer_id, order_status,
  CAST(order_total_usd AS DECIMAL(18,2)) AS order_total_usd,
  CAST(order_total_amount AS DECIMAL(18,4)) AS order_total_original,
  currency_code, channel, shipping_country, item_count, is_high_value, order_size_tier, is_international,
  order_date, order_created_at, order_updated_at, _cdc_operation, _ingested_at
FROM {silver}""")


def enriched_cte(name: str, stg: str) -> None:
    cte(name, [stg, "stg_customers"], f"""
SELECT o.*, c.customer_tier, c.country_code AS customer_country, c.acquisition_channel,
  CAST(datediff('day', CAST(c.customer_created_at AS DATE), o.order_date) AS INTEGER) AS days_since_customer_signup,
  CASE WHEN o.shipping_country = c.country_code THEN FALSE ELSE TRUE END AS is_cross_border,
  {BAND_SQL.format(c="o.order_total_usd")} AS revenue_band
FROM {stg} o LEFT JOIN stg_customers c USING (customer_id)""")


def fct_cte(name: str, enriched: str, as_of_ts: str) -> None:
    cte(name, [enriched], f"""
SELECT order_id, customer_id, order_status, channel, shipping_country, customer_country,
  acquisition_channel, customer_tier, revenue_band, order_size_tier, item_count,
  order_total_usd, order_total_original, currency_code, is_high_value, is_international, is_cross_border,
  CAST(CASE WHEN order_status IN {COMPLETED_IN} THEN order_total_usd ELSE 0 END AS DECIMAL(18,2)) AS recognised_revenue_usd,
  CAST(CASE WHEN order_status IN {EXCLUDED_IN} THEN order_total_usd ELSE 0 END AS DECIMAL(18,2)) AS lost_revenue_usd,
  order_date, order_created_at, order_updated_at, days_since_customer_signup,
  _ingested_at AS _loaded_at, TIMESTAMP '{as_of_ts}' AS _updated_at
FROM {enriched}""")


AS_OF_TS = "2001-08-02 06:00:00"
stg_orders_cte("stg_orders", "silver_orders")
enriched_cte("orders_enriched", "stg_orders")
fct_cte("fct_orders", "orders_enriched", AS_OF_TS)
stg_orders_cte("first_stg_orders", "first_silver_orders")
enriched_cte("first_enriched", "first_stg_orders")
fct_cte("first_fct", "first_enriched", AS_OF_TS)


def revenue_summary_sql(src: str = "fct_orders") -> str:
    n = "count(order_id)"
    canc = f"count(CASE WHEN order_status IN {EXCLUDED_IN} THEN 1 END)"
    return f"""
SELECT order_date, channel, customer_tier, shipping_country AS country_code, revenue_band,
  {n} AS total_orders,
  count(CASE WHEN order_status = 'delivered' THEN 1 END) AS delivered_orders,
  {canc} AS cancelled_orders,
  CAST(sum(item_count) AS BIGINT) AS total_items_sold,
  CAST(sum(order_total_usd) AS DECIMAL(18,2)) AS gross_revenue_usd,
  CAST(sum(recognised_revenue_usd) AS DECIMAL(18,2)) AS recognised_revenue_usd,
  CAST(sum(lost_revenue_usd) AS DECIMAL(18,2)) AS lost_revenue_usd,
  CAST(sum(order_total_usd) - sum(lost_revenue_usd) AS DECIMAL(18,2)) AS net_revenue_usd,
  {avg4_exact("order_total_usd", f"order_status IN {COMPLETED_IN}")} AS aov_usd,
  round(CAST({canc} AS DOUBLE) / CAST(nullif({n}, 0) AS DOUBLE), 4) AS cancellation_rate,
  round(CAST(count(CASE WHEN is_high_value THEN 1 END) AS DOUBLE) / CAST(nullif({n}, 0) AS DOUBLE), 4) AS high_value_order_pct,
  round(CAST(count(CASE WHEN is_international THEN 1 END) AS DOUBLE) / CAST(nullif({n}, 0) AS DOUBLE), 4) AS international_order_pct,
  TIMESTAMP '{AS_OF_TS}' AS _updated_at
FROM {src} GROUP BY 1, 2, 3, 4, 5"""


# --- transactions -----------------------------------------------------------
_LAT = "[" + ", ".join(f"CAST({c[0]} AS DOUBLE)" for c in A.CITIES) + "]"
_LON = "[" + ", ".join(f"CAST({c[1]} AS DOUBLE)" for c in A.CITIES) + "]"
cte("burst_events", [], f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events
UNION ALL
SELECT event_id * 100 + c + 1000000000 AS event_id, ts + to_seconds(c * g) AS ts, user_id, event_type, value, props
FROM (SELECT *, unnest(generate_series(1, CASE WHEN event_id % {A.BURST_MODULUS} = 0 THEN {A.BURST_SHORT[0]} ELSE {A.BURST_LONG[0]} END)) AS c,
        CASE WHEN event_id % {A.BURST_MODULUS} = 0 THEN {A.BURST_SHORT[1]} ELSE {A.BURST_LONG[1]} END AS g
      FROM events WHERE event_id % {A.BURST_MODULUS} IN (0, 100))""")
cte("transactions", ["burst_events"], f"""
SELECT 'TX-' || event_id AS transaction_id, 'CARD-' || user_id AS card_id,
  'CUST-' || (user_id % 50) AS customer_id, 'M-' || (event_id % 97) AS merchant_id,
  CAST(CAST(value AS DECIMAL(18,2)) * CAST(3 AS DECIMAL(1,0)) AS DECIMAL(18,4)) AS amount_usd,
  'USD' AS currency, event_type AS merchant_category,
  CASE WHEN event_id % 20 = 0 THEN 'DEV-' || user_id || '-' || event_id ELSE 'DEV-' || user_id END AS device_fingerprint,
  '10.0.' || (user_id % 256) || '.' || (event_id % 256) AS ip_address,
  CAST(({_LAT})[city + 1] AS FLOAT) AS latitude,
  CAST(({_LON})[city + 1] AS FLOAT) AS longitude,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
  ts AS event_ts
FROM (SELECT *, CASE WHEN event_id % 25 = 0 THEN (user_id % 4 + 1) % 4 ELSE user_id % 4 END AS city FROM burst_events)""")


def _frame(seconds: int) -> str:
    return f"RANGE BETWEEN INTERVAL {seconds} SECONDS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING"


cte("tx_features", ["transactions"], f"""
SELECT *,
  count(*) OVER (PARTITION BY card_id ORDER BY event_ts {_frame(60)}) AS tx_count_1min,
  count(*) OVER (PARTITION BY card_id ORDER BY event_ts {_frame(300)}) AS tx_count_5min,
  count(*) OVER (PARTITION BY card_id ORDER BY event_ts {_frame(30 * 86400)}) AS amount_count_30d,
  CAST(coalesce(sum(amount_usd) OVER (PARTITION BY card_id ORDER BY event_ts {_frame(30 * 86400)}), 0) AS DECIMAL(28,4)) AS amount_sum_30d,
  lag(latitude) OVER (PARTITION BY card_id ORDER BY event_ts, transaction_id) AS last_latitude,
  lag(longitude) OVER (PARTITION BY card_id ORDER BY event_ts, transaction_id) AS last_longitude,
  lag(event_ts) OVER (PARTITION BY card_id ORDER BY event_ts, transaction_id) AS last_tx_timestamp,
  device_fingerprint IS NOT NULL AND count(*) OVER (PARTITION BY card_id, device_fingerprint ORDER BY event_ts {_frame(90 * 86400)}) > 0 AS device_seen_90d,
  merchant_category IS NOT NULL AND count(*) OVER (PARTITION BY card_id, merchant_category ORDER BY event_ts {_frame(30 * 86400)}) > 0 AS category_seen_30d
FROM transactions""")

_RAD = "(pi() / 180.0)"
cte("tx_scored_features", ["tx_features"], f"""
SELECT *,
  CASE WHEN amount_count_30d > 0 THEN CAST(((2 * CAST(amount_sum_30d * 10000 AS HUGEINT) + amount_count_30d) // (2 * amount_count_30d)) / 10000.0 AS DECIMAL(18,4))
       ELSE CAST(0 AS DECIMAL(18,4)) END AS avg_amount_30d,
  CASE WHEN elapsed_hours > 0 THEN distance_km / elapsed_hours END AS speed_kmh
FROM (
  SELECT *,
    12742.0 * atan2(sqrt(_a), sqrt(1.0 - _a)) AS distance_km,
    CAST(epoch_us(event_ts) - epoch_us(last_tx_timestamp) AS DOUBLE) / 3600000000.0 AS elapsed_hours
  FROM (
    SELECT *,
      pow(sin((CAST(latitude AS DOUBLE) - CAST(last_latitude AS DOUBLE)) * {_RAD} / 2), 2)
      + cos(CAST(last_latitude AS DOUBLE) * {_RAD}) * cos(CAST(latitude AS DOUBLE) * {_RAD})
      * pow(sin((CAST(longitude AS DOUBLE) - CAST(last_longitude AS DOUBLE)) * {_RAD} / 2), 2) AS _a
    FROM tx_features))""")

BLOCKLIST = ["M-13", "M-42"]


def fraud_chain(prefix: str, src: str) -> None:
    """Rules, decision and scored record over a feature CTE ``src``."""
    p = prefix
    cte(f"{p}rules", [src], f"""
SELECT *,
  merchant_id IN {_in_list(BLOCKLIST)} AS r_blacklisted_merchant,
  tx_count_1min >= 5 AS r_velocity_1min,
  tx_count_5min >= 10 AS r_velocity_5min,
  (amount_count_30d > 0 AND amount_sum_30d > 0 AND amount_usd * amount_count_30d > CAST(3.0 AS DECIMAL(10,4)) * amount_sum_30d) AS r_amount_spike,
  coalesce(speed_kmh > 900.0, FALSE) AS r_geo_impossibility,
  (NOT coalesce(device_seen_90d, FALSE)) AND amount_usd > 500.0 AS r_new_device_high_amount,
  coalesce(length(merchant_category) > 0, FALSE) AND NOT coalesce(category_seen_30d, FALSE) AS r_unusual_merchant_category
FROM {src}""")
    cte(f"{p}decided", [f"{p}rules"], f"""
SELECT *,
  CASE WHEN r_blacklisted_merchant OR r_velocity_1min OR r_geo_impossibility OR len(rl) >= 2 THEN 'BLOCK'
       WHEN len(rl) >= 1 THEN 'REVIEW' ELSE 'PASS' END AS fraud_decision,
  CASE WHEN r_blacklisted_merchant THEN 'Merchant ' || merchant_id || ' is on the fraud watchlist'
       WHEN r_velocity_1min THEN 'Card exceeded 5 transactions in 60s'
       WHEN r_geo_impossibility THEN 'Transaction location is physically impossible given previous activity'
       WHEN len(rl) >= 2 THEN 'Multiple fraud signals detected: ' || array_to_string(rl, ', ')
       WHEN len(rl) >= 1 THEN 'Suspicious signals: ' || array_to_string(rl, ', ')
       ELSE 'No fraud signals' END AS decision_reason
FROM (
  SELECT *,
    CASE WHEN r_blacklisted_merchant THEN ['blacklisted_merchant']
         WHEN r_velocity_1min THEN ['velocity_1min']
         WHEN r_geo_impossibility THEN list_concat(pre, ['geo_impossibility'])
         ELSE list_concat(pre, post) END AS rl
  FROM (
    SELECT *,
      list_filter([CASE WHEN r_velocity_5min THEN 'velocity_5min' END, CASE WHEN r_amount_spike THEN 'amount_spike' END], lambda x: x IS NOT NULL) AS pre,
      list_filter([CASE WHEN r_new_device_high_amount THEN 'new_device_high_amount' END, CASE WHEN r_unusual_merchant_category THEN 'unusual_merchant_category' END], lambda x: x IS NOT NULL) AS post
    FROM {p}rules))""")
    cte(f"{p}scored", [f"{p}decided"], f"""
SELECT transaction_id, card_id, customer_id, amount_usd, fraud_decision,
  CAST(to_json(rl) AS VARCHAR) AS triggered_rules, CAST(0.0 AS FLOAT) AS fraud_score, decision_reason,
  TIMESTAMP '{AS_OF_TS}' AS processed_at
FROM {p}decided""")


fraud_chain("tx_", "tx_scored_features")

PROFILE_DATE = "2024-01-20"
cte("stream_features", ["tx_scored_features"], f"""
SELECT f.* EXCLUDE (amount_count_30d, amount_sum_30d, device_seen_90d, category_seen_30d),
  coalesce(a.n, 0) AS amount_count_30d, CAST(coalesce(a.s, 0) AS DECIMAL(28,4)) AS amount_sum_30d,
  EXISTS (SELECT 1 FROM transactions d WHERE d.card_id = f.card_id AND d.device_fingerprint = f.device_fingerprint
          AND CAST(d.event_ts AS DATE) <= DATE '{PROFILE_DATE}' AND CAST(d.event_ts AS DATE) > DATE '{PROFILE_DATE}' - INTERVAL 90 DAY) AS device_seen_90d,
  EXISTS (SELECT 1 FROM transactions c WHERE c.card_id = f.card_id AND c.merchant_category = f.merchant_category
          AND CAST(c.event_ts AS DATE) <= DATE '{PROFILE_DATE}' AND CAST(c.event_ts AS DATE) > DATE '{PROFILE_DATE}' - INTERVAL 30 DAY) AS category_seen_30d
FROM tx_scored_features f LEFT JOIN (
  SELECT card_id, sum(amount_usd) AS s, count(*) AS n FROM transactions
  WHERE CAST(event_ts AS DATE) <= DATE '{PROFILE_DATE}' AND CAST(event_ts AS DATE) > DATE '{PROFILE_DATE}' - INTERVAL 30 DAY
  GROUP BY card_id) a ON a.card_id = f.card_id""")
fraud_chain("stream_", "stream_features")


# --- CDC envelope path ---------------------------------------------------------
RUN_DATE = "2001-08-02"
cte("cdc_events", ["orders_versions"], """
SELECT *,
  CASE WHEN (o_orderkey + _version) % 10 = 0 THEN 'd' WHEN (o_orderkey + _version) % 10 = 1 THEN NULL
       WHEN (o_orderkey + _version) % 10 = 2 THEN 'r' ELSE _cdc_operation END AS op,
  (o_orderkey * 4 + _version) % 97 = 0 AS broken
FROM orders_versions""")
_FLAT = f"""order_id, customer_id, order_status, order_total_amount, currency_code, channel, created_at, updated_at,
  shipping_country, item_count, op AS _cdc_operation, _kafka_timestamp_ms, '{RUN_DATE}' AS _ingestion_date,
  TIMESTAMP '{AS_OF_TS}' AS _ingested_at, _source_system"""
cte("cdc_flat", ["cdc_events"], f"SELECT {_FLAT} FROM cdc_events WHERE op IN ('c', 'u', 'r')")
cte("cdc_bronze", ["cdc_events"], f"SELECT {_FLAT} FROM cdc_events WHERE NOT broken AND op IN ('c', 'u', 'r')")
silver_chain("cdc_silver_", "cdc_bronze")
stg_orders_cte("cdc_stg_orders", "cdc_silver_orders")
enriched_cte("cdc_enriched", "cdc_stg_orders")
fct_cte("cdc_fct", "cdc_enriched", AS_OF_TS)
silver_chain("cdcflat_silver_", "cdc_flat")
