"""Fixed values that results depend on.

These are business constants (domains, rates, thresholds, segment rules). They
are stated here once, plainly and in natural order; every operator takes them
as overridable parameters.
"""

from __future__ import annotations

from decimal import Decimal

# --- fixed values: order domains -------------------------------------------
VALID_ORDER_STATUSES = [
    "pending", "confirmed", "processing", "shipped",
    "delivered", "cancelled", "refunded", "returned",
]
VALID_CHANNELS = ["web", "mobile_ios", "mobile_android", "marketplace", "in_store"]
COMPLETED_STATUSES = ["delivered", "shipped"]
EXCLUDED_STATUSES = ["cancelled", "refunded", "returned"]
CDC_KEEP_OPS = ["c", "u", "r"]
DOMESTIC_COUNTRIES = ["US", "USA"]
SOURCE_SYSTEM = "orders-cdc-s3-sink"

# --- fixed values: currency rates to USD (decimal(10,5)) --------------------
FX_RATES_TO_USD = {
    "USD": Decimal("1.00000"),
    "EUR": Decimal("1.08000"),
    "GBP": Decimal("1.27000"),
    "CAD": Decimal("0.74000"),
    "AUD": Decimal("0.65000"),
    "NGN": Decimal("0.00065"),
}

# --- fixed values: derived flags and bands ----------------------------------
HIGH_VALUE_USD = 500
SIZE_TIERS = [(1, "single_item"), (5, "small_basket"), (20, "medium_basket")]
SIZE_TIER_ELSE = "large_basket"
REVENUE_BANDS = [(25, "micro"), (100, "small"), (500, "medium"), (2000, "large")]
REVENUE_BAND_ELSE = "enterprise"

# --- fixed values: LTV segments (first match wins) --------------------------
LTV_SEGMENTS = ["champions", "loyal", "at_risk", "new_customers", "low_value"]
CHAMPION_MIN_REVENUE_L12M = 1000
CHAMPION_MAX_RECENCY_DAYS = 30
CHAMPION_MAX_CANCEL_RATE = 0.1
LOYAL_MIN_ORDERS_L12M = 4
LOYAL_MIN_REVENUE_L12M = 300
AT_RISK_MIN_TOTAL_REVENUE = 500
AT_RISK_MIN_RECENCY_DAYS = 180
NEW_CUSTOMER_MAX_RECENCY_DAYS = 90
DEFAULT_SEGMENT = "new_customers"

# --- fixed values: incremental merge and quality gates ----------------------
INCREMENTAL_LOOKBACK_DAYS = 3
VOLUME_TOLERANCE = 0.30
BRONZE_VOLUME_TOLERANCE = 0.35
FRESHNESS_WARN_HOURS = 2
FRESHNESS_ERROR_HOURS = 6

# --- fixed values: fraud rules ----------------------------------------------
VELOCITY_1MIN_THRESHOLD = 5
VELOCITY_5MIN_THRESHOLD = 10
AMOUNT_SPIKE_MULTIPLIER = 3.0
HIGH_AMOUNT_NEW_DEVICE = 500.0
GEO_SPEED_KMH_MAX = 900.0
REVIEW_SCORE_ACCUMULATE = 2
EARTH_RADIUS_KM = 6371.0
VELOCITY_SHORT_SECONDS = 60
VELOCITY_LONG_SECONDS = 300
AMOUNT_WINDOW_DAYS = 30
DEVICE_WINDOW_DAYS = 90
CATEGORY_WINDOW_DAYS = 30
PROFILE_TTL_DAYS = 35
SCORE_BLOCK_ABOVE = 0.85
SCORE_REVIEW_FROM = 0.6
RISK_ACTIONS = ["BLOCK", "REVIEW"]
MAX_RECORDS_PER_TRIGGER = 10_000
TRIGGER_INTERVAL = "500 milliseconds"
