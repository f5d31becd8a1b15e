"""Stand-in inputs derived from the driver's tables.

The reference reads CDC order events, a customer table and card transactions.
Here those shapes are derived from ``orders``, ``customer`` and ``events`` with
deterministic rules (modulus picks from fixed spelling lists), so every query's
work grows with the given tables and the same rows can be rebuilt in SQL.
Everything is a lazy DataFrame; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: spellings used to plant normalisation work ---------------
STATUS_SPELLINGS = [
    "  Pending", "confirmed", "PROCESSING ", "shipped",
    " Delivered", "cancelled", "REFUNDED", "returned ",
]
CURRENCY_SPELLINGS = ["USD", "eur", " GBP", "CAD", "aud ", "NGN"]
CHANNEL_SPELLINGS = ["web", " MOBILE_IOS", "mobile_android", "Marketplace ", "in_store"]
COUNTRY_CODES = ["US", "GB", "DE", "FR", "CA", "NG", "AU", "USA"]
ACQUISITION_SPELLINGS = [" Organic", "PAID_SEARCH", "referral ", "social"]
SEGMENT_TIERS = {
    "AUTOMOBILE": "bronze",
    "BUILDING": "silver",
    "FURNITURE": "gold",
    "HOUSEHOLD": "platinum",
    "MACHINERY": "bronze",
}
TIER_ROTATION = ["bronze", "silver", "gold", "platinum"]
# city centres (latitude, longitude) for card home and travel positions
CITIES = [
    (40.7128, -74.006),
    (51.5074, -0.1278),
    (6.5244, 3.3792),
    (-33.8688, 151.2093),
]
CUSTOMER_CREATED_BASE = "1994-01-01"
DATE_OF_BIRTH_BASE = "1950-01-01"
CUSTOMER_INGESTED_AT = "2001-08-02 06:00:00"
DIRTY_MODULUS = 101
BURST_SHORT = (12, 4)   # copies, seconds apart: velocity_1min bursts
BURST_LONG = (14, 20)   # copies, seconds apart: velocity_5min-only bursts
BURST_MODULUS = 200


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _ts_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_versions(orders: DataFrame) -> DataFrame:
    """One CDC row state per order version; all values strings, bronze-shaped."""
    k = F.col("o_orderkey")
    v = F.col("v")
    base = orders.select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("_odate"),
        F.explode(F.sequence(F.lit(1), (k % 3 + 1).cast("int"))).alias("v"),
    )
    created = F.timestamp_seconds(F.unix_seconds(F.col("_odate")) + k % 86400)
    updated = F.timestamp_seconds(F.unix_seconds(F.col("_odate")) + k % 86400 + v * 3600)
    country_index = (F.col("o_custkey") + F.when(k % 4 == 0, 1).otherwise(0)) % len(COUNTRY_CODES)
    country = _pick(COUNTRY_CODES, country_index)
    amount = F.round(F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.005).cast("decimal(3,3)"), 4)
    return base.select(
        F.col("o_orderkey"),
        F.col("v").alias("_version"),
        F.concat(F.lit("ORD-"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        _pick(STATUS_SPELLINGS, (k + v) % 8).alias("order_status"),
        amount.cast("decimal(18,4)").cast("string").alias("order_total_amount"),
        _pick(CURRENCY_SPELLINGS, k % 6).alias("currency_code"),
        _pick(CHANNEL_SPELLINGS, F.col("o_custkey") % 5).alias("channel"),
        _ts_text(created).alias("created_at"),
        _ts_text(updated).alias("updated_at"),
        F.when(k % 53 == 0, F.lit(None).cast("string"))
        .when(k % 9 == 0, F.concat(F.lit("  "), F.lower(country), F.lit(" ")))
        .otherwise(country)
        .alias("shipping_country"),
        F.when(k % 61 == 0, F.lit(None).cast("string"))
        .otherwise((k % 30 + 1).cast("string"))
        .alias("item_count"),
        F.when(v == 1, F.lit("c")).otherwise(F.lit("u")).alias("_cdc_operation"),
        (F.unix_seconds(updated) * 1000).cast("string").alias("_kafka_timestamp_ms"),
        F.date_format(updated, "yyyy-MM-dd").alias("_ingestion_date"),
        (updated + F.expr("INTERVAL 30 MINUTES")).alias("_ingested_at"),
        F.lit("orders-cdc-s3-sink").alias("_source_system"),
    )


def orders_dirty(orders: DataFrame) -> DataFrame:
    """``orders_versions`` with one planted fault on the first version of
    every order whose key hits a fault slot (modulus 101)."""
    df = orders_versions(orders)
    slot = F.when(F.col("_version") == 1, F.col("o_orderkey") % DIRTY_MODULUS).otherwise(-1)
    null = F.lit(None).cast("string")
    return (
        df.withColumn("_slot", slot)
        .withColumn("order_id", F.when(F.col("_slot") == 1, null).otherwise(F.col("order_id")))
        .withColumn(
            "order_total_amount",
            F.when(F.col("_slot") == 2, F.concat(F.lit("-"), F.col("order_total_amount")))
            .when(F.col("_slot") == 3, F.lit("N/A"))
            .otherwise(F.col("order_total_amount")),
        )
        .withColumn(
            "order_status",
            F.when(F.col("_slot") == 4, F.lit("lost"))
            .when(F.col("_slot") == 5, null)
            .otherwise(F.col("order_status")),
        )
        .withColumn(
            "channel",
            F.when(F.col("_slot") == 6, F.lit("fax"))
            .when(F.col("_slot") == 10, null)
            .otherwise(F.col("channel")),
        )
        .withColumn("created_at", F.when(F.col("_slot") == 7, F.lit("not-a-date")).otherwise(F.col("created_at")))
        .withColumn("currency_code", F.when(F.col("_slot") == 8, F.lit("JPY")).otherwise(F.col("currency_code")))
        .withColumn("customer_id", F.when(F.col("_slot") == 9, null).otherwise(F.col("customer_id")))
        .drop("_slot")
    )


def bronze_rows(orders: DataFrame, dirty: bool = True) -> DataFrame:
    """Bronze-shaped rows (the ten strings + audit columns)."""
    df = orders_dirty(orders) if dirty else orders_versions(orders)
    return df.drop("o_orderkey", "_version")


def cdc_events(orders: DataFrame) -> DataFrame:
    """CDC envelopes (op, ts_ms, after) with every op kind present:
    delete and NULL op besides create / update / snapshot read."""
    df = orders_versions(orders)
    sel = (F.col("o_orderkey") + F.col("_version")) % 10
    op = (
        F.when(sel == 0, F.lit("d"))
        .when(sel == 1, F.lit(None).cast("string"))
        .when(sel == 2, F.lit("r"))
        .otherwise(F.col("_cdc_operation"))
    )
    after = F.struct(
        "order_id", "customer_id", "order_status", "order_total_amount", "currency_code",
        "channel", "created_at", "updated_at", "shipping_country", "item_count",
    )
    return df.select(
        "o_orderkey", "_version",
        op.alias("op"), F.col("_kafka_timestamp_ms").alias("ts_ms"), after.alias("after"),
    )


def cdc_json_lines(orders: DataFrame) -> DataFrame:
    """JSON-lines text of the envelopes; every 97th line is cut short."""
    ev = cdc_events(orders)
    line = F.to_json(F.struct("op", "ts_ms", "after"))
    broken = (F.col("o_orderkey") * 4 + F.col("_version")) % 97 == 0
    return ev.select(
        F.when(broken, F.substring(line, 1, 40)).otherwise(line).alias("value")
    )


def customers_src(customer: DataFrame) -> DataFrame:
    """Source customer rows as a CRM extract would hold them (messy strings)."""
    k = F.col("c_custkey")
    tier = F.coalesce(
        F.element_at(
            F.create_map(*[x for kv in SEGMENT_TIERS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]),
            F.col("c_mktsegment"),
        ),
        F.lit("bronze"),
    )
    created = F.date_add(F.lit(CUSTOMER_CREATED_BASE).cast("date"), (k % 365).cast("int"))
    country = _pick(COUNTRY_CODES, k % len(COUNTRY_CODES))
    return customer.select(
        F.concat(F.lit("CUST-"), k.cast("string")).alias("customer_id"),
        F.concat(F.lit("  "), F.upper(F.col("c_name")), F.lit("@Example.COM ")).alias("email"),
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Name"), (k % 97).cast("string")))
        .alias("first_name"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Family"), (k % 89).cast("string")))
        .alias("last_name"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.lower(country))).otherwise(country).alias("country_code"),
        _pick(ACQUISITION_SPELLINGS, F.col("c_nationkey") % 4).alias("acquisition_channel"),
        tier.alias("customer_tier"),
        F.when(k % 3 == 0, F.lit("false")).otherwise(F.lit("true")).alias("is_email_verified"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("is_marketing_opted_in"),
        F.concat(created.cast("string"), F.lit(" 08:00:00")).alias("created_at"),
        F.concat(F.date_add(created, (k % 1000).cast("int")).cast("string"), F.lit(" 09:30:00")).alias("updated_at"),
        F.date_add(F.lit(DATE_OF_BIRTH_BASE).cast("date"), (k * 37 % 18000).cast("int")).cast("string").alias("date_of_birth"),
        F.lit(CUSTOMER_INGESTED_AT).cast("timestamp").alias("_ingested_at"),
    )


def customer_versions(customer: DataFrame) -> DataFrame:
    """Change log of customers: 1 + key % 3 versions, tier rotated per
    version, versions 400 days apart (SCD2 and as-of inputs)."""
    src = customers_src(customer)
    key = F.element_at(F.split(F.col("customer_id"), "-"), 2).cast("bigint")
    df = src.withColumn("_k", key).withColumn(
        "_version", F.explode(F.sequence(F.lit(1), (F.col("_k") % 3 + 1).cast("int")))
    )
    base_updated = F.to_timestamp(F.col("created_at"))
    tier_index = (F.col("_k") + F.col("_version")) % len(TIER_ROTATION)
    return df.select(
        "customer_id", "email", "first_name", "last_name", "country_code",
        "acquisition_channel",
        _pick(TIER_ROTATION, tier_index).alias("customer_tier"),
        "is_email_verified", "is_marketing_opted_in", "date_of_birth", "created_at",
        F.date_format(
            base_updated + F.make_interval(days=((F.col("_version") - 1) * 400).cast("int")),
            "yyyy-MM-dd HH:mm:ss",
        ).alias("updated_at"),
        "_ingested_at",
        F.col("_version"),
    )


def transactions(events: DataFrame) -> DataFrame:
    """Card transactions (TRANSACTION schema) from ``events``."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    home = uid % 4
    city = F.when(eid % 25 == 0, (home + 1) % 4).otherwise(home)
    lat = F.element_at(F.array(*[F.lit(c[0]) for c in CITIES]), (city + 1).cast("int"))
    lon = F.element_at(F.array(*[F.lit(c[1]) for c in CITIES]), (city + 1).cast("int"))
    device = F.when(
        eid % 20 == 0,
        F.concat(F.lit("DEV-"), uid.cast("string"), F.lit("-"), eid.cast("string")),
    ).otherwise(F.concat(F.lit("DEV-"), uid.cast("string")))
    return events.select(
        F.concat(F.lit("TX-"), eid.cast("string")).alias("transaction_id"),
        F.concat(F.lit("CARD-"), uid.cast("string")).alias("card_id"),
        F.concat(F.lit("CUST-"), (uid % 50).cast("string")).alias("customer_id"),
        F.concat(F.lit("M-"), (eid % 97).cast("string")).alias("merchant_id"),
        (F.col("value").cast("decimal(18,2)") * F.lit(3).cast("decimal(1,0)")).cast("decimal(18,4)").alias("amount_usd"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("merchant_category"),
        device.alias("device_fingerprint"),
        F.concat(F.lit("10.0."), (uid % 256).cast("string"), F.lit("."), (eid % 256).cast("string")).alias("ip_address"),
        lat.cast("float").alias("latitude"),
        lon.cast("float").alias("longitude"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
    )


def transactions_burst(events: DataFrame) -> DataFrame:
    """``transactions`` plus planted bursts: 12 copies 4 s apart after each
    event with id % 200 = 0, and 14 copies 20 s apart after each with
    id % 200 = 100, so both velocity rules fire."""
    eid = F.col("event_id")
    base = events
    short_n, short_gap = BURST_SHORT
    long_n, long_gap = BURST_LONG
    burst = (
        events.where((eid % BURST_MODULUS == 0) | (eid % BURST_MODULUS == 100))
        .withColumn(
            "_copy",
            F.explode(
                F.sequence(F.lit(1), F.when(eid % BURST_MODULUS == 0, short_n).otherwise(long_n))
            ),
        )
        .withColumn("_gap", F.when(eid % BURST_MODULUS == 0, short_gap).otherwise(long_gap))
    )
    copies = burst.select(
        (eid * 100 + F.col("_copy") + 1_000_000_000).alias("event_id"),
        (F.col("ts").cast("timestamp") + F.make_interval(secs=(F.col("_copy") * F.col("_gap")).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("ts"),
        "user_id", "event_type", "value", "props",
    )
    return transactions(base.select(copies.columns).unionByName(copies))
