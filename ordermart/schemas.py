"""Declared schemas at the ingest edges and for published tables."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DecimalType, FloatType, LongType, StringType, StructField, StructType

# --- fixed values: names and types of the fields that producers send ---------
ORDER_FIELDS = [
    "order_id", "customer_id", "order_status", "order_total_amount",
    "currency_code", "channel", "created_at", "updated_at",
    "shipping_country", "item_count",
]

# CDC envelope: op, ts_ms and the row state in ``after``; all values strings.
CDC_AFTER = StructType([StructField(name, StringType(), True) for name in ORDER_FIELDS])
CDC_ENVELOPE = StructType(
    [
        StructField("op", StringType(), True),
        StructField("ts_ms", StringType(), True),
        StructField("after", CDC_AFTER, True),
    ]
)
CORRUPT_COLUMN = "_corrupt_record"
CDC_ENVELOPE_WITH_CORRUPT = StructType(
    CDC_ENVELOPE.fields + [StructField(CORRUPT_COLUMN, StringType(), True)]
)

#: Events that Bronze does not take, and one row of measures per layer and run.
CDC_REJECTS = StructType(CDC_ENVELOPE.fields + [StructField("_reject_reason", StringType(), True)])
RUN_METRICS = StructType(
    [StructField(name, LongType(), True) for name in ("input_rows", "kept_rows", "rejected_rows", "null_keys", "newest_ts_ms")]
    + [StructField("passed", BooleanType(), True)]
)

TRANSACTION = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("card_id", StringType(), False),
        StructField("customer_id", StringType(), False),
        StructField("merchant_id", StringType(), False),
        StructField("amount_usd", DecimalType(18, 4), False),
        StructField("currency", StringType(), True),
        StructField("merchant_category", StringType(), True),
        StructField("device_fingerprint", StringType(), True),
        StructField("ip_address", StringType(), True),
        StructField("latitude", FloatType(), True),
        StructField("longitude", FloatType(), True),
        StructField("event_time", StringType(), False),
    ]
)
