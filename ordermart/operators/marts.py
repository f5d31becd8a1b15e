"""Mart models as DataFrame functions.

Each model is a function over lazy DataFrames; composing the functions is the
model-reference graph, and Catalyst inlines it like CTEs. Audit clocks take an
injected ``as_of`` so results repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.functions.columns import count_when, is_cross_border, revenue_band, safe_ratio


def stage_orders(silver: DataFrame) -> DataFrame:
    """Rename, cast, narrow to the published order columns."""
    return silver.select(
        "order_id", "customer_id", "order_status",
        F.col("order_total_usd").cast("decimal(18,2)").alias("order_total_usd"),
        F.col("order_total_amount").cast("decimal(18,4)").alias("order_total_original"),
        "currency_code", "channel", "shipping_country",
        F.col("item_count").cast("int").alias("item_count"),
        "is_high_value", "order_size_tier", "is_international",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("order_created_at").cast("timestamp").alias("order_created_at"),
        F.col("order_updated_at").cast("timestamp").alias("order_updated_at"),
        "_cdc_operation", "_ingested_at",
    )


def stage_customers(src: DataFrame) -> DataFrame:
    """trim/lower email and channel, default names, upper country,
    booleans and dates typed. A text that does not parse becomes NULL (and is
    listed by :func:`unparsable_customers`) instead of failing the job."""
    return src.select(
        "customer_id",
        F.lower(F.trim(F.col("email"))).alias("email"),
        F.coalesce(F.col("first_name"), F.lit("Unknown")).alias("first_name"),
        F.coalesce(F.col("last_name"), F.lit("")).alias("last_name"),
        F.upper(F.trim(F.col("country_code"))).alias("country_code"),
        F.lower(F.trim(F.col("acquisition_channel"))).alias("acquisition_channel"),
        "customer_tier",
        F.col("is_email_verified").try_cast("boolean").alias("is_email_verified"),
        F.col("is_marketing_opted_in").try_cast("boolean").alias("is_marketing_opted_in"),
        F.col("created_at").try_cast("timestamp").alias("customer_created_at"),
        F.col("updated_at").try_cast("timestamp").alias("customer_updated_at"),
        F.col("date_of_birth").try_cast("date").alias("date_of_birth"),
        "_ingested_at",
    )


#: Customer columns that arrive as text, and their types.
CUSTOMER_TYPES = {"is_email_verified": "boolean", "is_marketing_opted_in": "boolean", "created_at": "timestamp",
                  "updated_at": "timestamp", "date_of_birth": "date"}


def unparsable_customers(src: DataFrame) -> DataFrame:
    """C7 rejects: rows with a text that is no value of its type, and which columns."""
    bad = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in CUSTOMER_TYPES.items()]))
    return src.withColumn("_unparsable", bad).where(F.size("_unparsable") > 0)


def enrich_orders(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """E2 + C9 + C10: orders left join current customers using customer_id.

    No broadcast hint: the customer dimension grows with the business, so
    AQE picks broadcast only when the runtime size is small, and splits a
    skewed customer partition of the sort-merge join otherwise."""
    cust = stg_customers.select(
        "customer_id", "customer_tier",
        F.col("country_code").alias("customer_country"),
        "acquisition_channel", "customer_created_at",
    )
    joined = stg_orders.join(cust, "customer_id", "left")
    return joined.select(
        *[F.col(c) for c in stg_orders.columns],
        "customer_tier", "customer_country", "acquisition_channel",
        F.datediff(F.col("order_date"), F.to_date(F.col("customer_created_at"))).alias("days_since_customer_signup"),
        is_cross_border(F.col("shipping_country"), F.col("customer_country")).alias("is_cross_border"),
        revenue_band(F.col("order_total_usd")).alias("revenue_band"),
    )


def recognise_revenue(df: DataFrame, amount: str = "order_total_usd") -> DataFrame:
    """C11: recognised (delivered, shipped) and lost (cancelled, refunded,
    returned) amounts, else 0."""
    zero = F.lit(0).cast("decimal(18,2)")
    status = F.col("order_status")
    return df.withColumn(
        "recognised_revenue_usd",
        F.when(status.isin(fixed.COMPLETED_STATUSES), F.col(amount)).otherwise(zero).cast("decimal(18,2)"),
    ).withColumn(
        "lost_revenue_usd",
        F.when(status.isin(fixed.EXCLUDED_STATUSES), F.col(amount)).otherwise(zero).cast("decimal(18,2)"),
    )


FCT_COLUMNS = [
    "order_id", "customer_id", "order_status", "channel", "shipping_country",
    "customer_country", "acquisition_channel", "customer_tier", "revenue_band",
    "order_size_tier", "item_count", "order_total_usd", "order_total_original",
    "currency_code", "is_high_value", "is_international", "is_cross_border",
    "recognised_revenue_usd", "lost_revenue_usd", "order_date", "order_created_at",
    "order_updated_at", "days_since_customer_signup", "_loaded_at", "_updated_at",
]


def fct_orders(enriched: DataFrame, as_of_ts: str) -> DataFrame:
    """Fact table grain: one row per order."""
    return (
        recognise_revenue(enriched)
        .withColumn("_loaded_at", F.col("_ingested_at"))
        .withColumn("_updated_at", F.lit(as_of_ts).cast("timestamp"))
        .select(FCT_COLUMNS)
    )


def dim_customers(stg_customers: DataFrame, ltv: DataFrame, as_of: str, as_of_ts: str) -> DataFrame:
    """E3 + C13 + N2: current-state customer dimension with LTV measures."""
    zero2 = F.lit(0).cast("decimal(18,2)")
    c = stg_customers.alias("c")
    j = c.join(ltv.alias("l"), "customer_id", "left")
    return j.select(
        "customer_id", "email", "first_name", "last_name",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        "country_code", "acquisition_channel", "customer_tier", "is_email_verified",
        "is_marketing_opted_in", "date_of_birth",
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("completed_orders"), F.lit(0)).cast("bigint").alias("completed_orders"),
        F.coalesce(F.col("cancelled_orders"), F.lit(0)).cast("bigint").alias("cancelled_orders"),
        F.coalesce(F.col("total_revenue_usd"), zero2).cast("decimal(18,2)").alias("total_revenue_usd"),
        "avg_order_value_usd", "first_order_date", "last_order_date", "days_since_last_order",
        F.coalesce(F.col("revenue_l12m_usd"), zero2).cast("decimal(18,2)").alias("revenue_l12m_usd"),
        F.coalesce(F.col("orders_l12m"), F.lit(0)).cast("bigint").alias("orders_l12m"),
        F.coalesce(F.col("ltv_segment"), F.lit(fixed.DEFAULT_SEGMENT)).alias("ltv_segment"),
        F.coalesce(F.col("cancel_rate"), F.lit(0.0)).cast("double").alias("cancel_rate"),
        F.datediff(F.lit(as_of).cast("date"), F.to_date(F.col("customer_created_at"))).alias("customer_age_days"),
        F.col("first_order_date").isNull().alias("is_never_purchased"),
        "customer_created_at", "customer_updated_at",
        F.lit(as_of_ts).cast("timestamp").alias("_updated_at"),
    )


REVENUE_KEYS = ["order_date", "channel", "customer_tier", "country_code", "revenue_band"]


def revenue_summary(fct: DataFrame, as_of_ts: str, keys: Sequence[str] = tuple(REVENUE_KEYS)) -> DataFrame:
    """Daily finance grain over five keys, one hash aggregate."""
    status = F.col("order_status")
    completed = status.isin(fixed.COMPLETED_STATUSES)
    cancelled = status.isin(fixed.EXCLUDED_STATUSES)
    n = F.count("order_id")
    df = fct.withColumnRenamed("shipping_country", "country_code")
    return df.groupBy(*keys).agg(
        n.alias("total_orders"),
        count_when(status == "delivered").alias("delivered_orders"),
        count_when(cancelled).alias("cancelled_orders"),
        F.sum("item_count").alias("total_items_sold"),
        F.sum("order_total_usd").cast("decimal(18,2)").alias("gross_revenue_usd"),
        F.sum("recognised_revenue_usd").cast("decimal(18,2)").alias("recognised_revenue_usd"),
        F.sum("lost_revenue_usd").cast("decimal(18,2)").alias("lost_revenue_usd"),
        (F.sum("order_total_usd") - F.sum("lost_revenue_usd")).cast("decimal(18,2)").alias("net_revenue_usd"),
        F.avg(F.when(completed, F.col("order_total_usd"))).cast("decimal(18,4)").alias("aov_usd"),
        safe_ratio(count_when(cancelled), n).alias("cancellation_rate"),
        safe_ratio(count_when(F.col("is_high_value")), n).alias("high_value_order_pct"),
        safe_ratio(count_when(F.col("is_international")), n).alias("international_order_pct"),
        F.lit(as_of_ts).cast("timestamp").alias("_updated_at"),
    )
