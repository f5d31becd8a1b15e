"""Card features for fraud rules.

Point-in-time: every feature of an event looks only at strictly earlier
events of the same card (scored before its own update). All windows go
through :mod:`ordermart.operators.fraud_windows`, which splits hot cards by
time so no single task holds one card's whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.functions.columns import elapsed_hours, haversine_km, parse_iso_instant
from ordermart.operators.fraud_windows import keyed_lag_lead, keyed_prev_time, trailing_counts, trailing_stats

DAY = 86400


def with_event_ts(tx: DataFrame, text_col: str = "event_time", out: str = "event_ts") -> DataFrame:
    """Parse the ISO-8601 event time once."""
    return tx.withColumn(out, parse_iso_instant(F.col(text_col)))


def velocity_counts(tx: DataFrame, ts: str = "event_ts") -> DataFrame:
    """earlier events of the card in the last 60 s and 300 s."""
    return trailing_counts(tx, ["card_id"], ts, {
        "tx_count_1min": fixed.VELOCITY_SHORT_SECONDS,
        "tx_count_5min": fixed.VELOCITY_LONG_SECONDS,
    })


def avg_amount_30d(tx: DataFrame, ts: str = "event_ts", days: int = fixed.AMOUNT_WINDOW_DAYS) -> DataFrame:
    """F3 (exact): sum and count of earlier amounts of the card in 30 days;
    ``avg_amount_30d`` = sum / count rounded to 4 places, 0 when none."""
    out = trailing_stats(
        tx, ["card_id"], ts, days * DAY, unit_seconds=DAY,
        values={"amount": F.col("amount_usd")}, prefix="_a30_",
    )
    return (
        out.withColumnRenamed("_a30_count", "amount_count_30d")
        .withColumn("amount_sum_30d", F.col("_a30_sum_amount").cast("decimal(28,4)"))
        .drop("_a30_sum_amount")
        .withColumn(
            "avg_amount_30d",
            F.when(F.col("amount_count_30d") > 0,
                   (F.col("amount_sum_30d") / F.col("amount_count_30d")).cast("decimal(18,4)"))
            .otherwise(F.lit(0).cast("decimal(18,4)")),
        )
    )


def last_position(tx: DataFrame, ts: str = "event_ts") -> DataFrame:
    """previous latitude, longitude and time of the card, ordered by
    (event time, transaction id)."""
    out = keyed_lag_lead(
        tx, ["card_id"], ts, ["latitude", "longitude", ts], direction="lag",
        tie="transaction_id", bucket_seconds=DAY, prefix="_prev_",
    )
    return (
        out.withColumnRenamed("_prev_latitude", "last_latitude")
        .withColumnRenamed("_prev_longitude", "last_longitude")
        .withColumnRenamed(f"_prev_{ts}", "last_tx_timestamp")
    )


def _seen_within(tx: DataFrame, keys: list[str], ts: str, days: int, value: str, out: str) -> DataFrame:
    """Has this key occurred in ``[t - days, t)``: the latest strictly
    earlier time of the key is within the window (no per-card set, no row
    replication). A NULL value is never seen."""
    prev = keyed_prev_time(tx, keys, ts, out="_prev_t", bucket_seconds=DAY)
    seen = F.col(value).isNotNull() & F.coalesce(
        F.col("_prev_t") >= F.col("_t") - F.lit(days * DAY * 1_000_000), F.lit(False))
    return prev.withColumn(out, seen).drop("_prev_t", "_t")


def device_seen(tx: DataFrame, ts: str = "event_ts", days: int = fixed.DEVICE_WINDOW_DAYS) -> DataFrame:
    """has this card used this device in the last 90 days (keyed by
    (card, device), no per-card set). A NULL device is never seen."""
    return _seen_within(tx, ["card_id", "device_fingerprint"], ts, days, "device_fingerprint", "device_seen_90d")


def category_seen(tx: DataFrame, ts: str = "event_ts", days: int = fixed.CATEGORY_WINDOW_DAYS) -> DataFrame:
    """has this card used this merchant category in the last 30 days."""
    return _seen_within(tx, ["card_id", "merchant_category"], ts, days, "merchant_category", "category_seen_30d")


def geo_speed(tx: DataFrame, ts: str = "event_ts") -> DataFrame:
    """I20 + I21: distance from the previous position and implied speed;
    NULL when a position or the previous time is missing or elapsed <= 0."""
    dist = haversine_km(F.col("last_latitude"), F.col("last_longitude"), F.col("latitude"), F.col("longitude"))
    hours = elapsed_hours(F.col(ts), F.col("last_tx_timestamp"))
    return tx.withColumn("distance_km", dist).withColumn("elapsed_hours", hours).withColumn(
        "speed_kmh", F.when(F.col("elapsed_hours") > 0, F.col("distance_km") / F.col("elapsed_hours"))
    )


def amounts_and_last_position(tx: DataFrame, ts: str = "event_ts", days: int = fixed.AMOUNT_WINDOW_DAYS) -> DataFrame:
    """F3 + F4 in one pass: both partition by (card, day), so the previous
    position rides on the 30-day amount window (one shuffle, not two)."""
    out = trailing_stats(
        tx, ["card_id"], ts, days * DAY, unit_seconds=DAY, values={"amount": F.col("amount_usd")},
        prefix="_a30_", lag_cols=["latitude", "longitude", ts], tie="transaction_id", lag_prefix="_prev_",
    )
    return (
        out.withColumnRenamed("_a30_count", "amount_count_30d")
        .withColumn("amount_sum_30d", F.col("_a30_sum_amount").cast("decimal(28,4)"))
        .drop("_a30_sum_amount")
        .withColumn(
            "avg_amount_30d",
            F.when(F.col("amount_count_30d") > 0,
                   (F.col("amount_sum_30d") / F.col("amount_count_30d")).cast("decimal(18,4)"))
            .otherwise(F.lit(0).cast("decimal(18,4)")),
        )
        .withColumnRenamed("_prev_latitude", "last_latitude")
        .withColumnRenamed("_prev_longitude", "last_longitude")
        .withColumnRenamed(f"_prev_{ts}", "last_tx_timestamp")
    )


def offline_features(tx: DataFrame) -> DataFrame:
    """Point-in-time feature row for every event (training table).
    Four keyed passes: velocity (card, 5-minute bucket), amounts + last
    position (card, day), devices (card, device, day), categories
    (card, category, day)."""
    df = with_event_ts(tx)
    df = velocity_counts(df)
    df = amounts_and_last_position(df)
    df = device_seen(df)
    df = category_seen(df)
    return geo_speed(df)


def nightly_profile(tx: DataFrame, as_of_date: str) -> DataFrame:
    """Per-card profile at the end of ``as_of_date`` (nightly refresh):
    30-day average amount, last position, distinct devices in 90 days and the
    merchant categories of 30 days. Devices are kept as a count (the set can
    grow with a card's history; rules use the keyed lookup of F5); the
    category set is bounded by the category domain. One aggregate per card
    with map-side partial aggregation."""
    df = with_event_ts(tx)
    end = F.lit(as_of_date).cast("date")
    end_ts = F.to_timestamp(F.date_add(end, 1))
    day = F.to_date(F.col("event_ts"))
    in30 = (day > F.date_sub(end, fixed.AMOUNT_WINDOW_DAYS)) & (day <= end)
    in90 = (day > F.date_sub(end, fixed.DEVICE_WINDOW_DAYS)) & (day <= end)
    order = F.struct(F.col("event_ts"), F.col("transaction_id"))
    last = F.max_by(F.struct("latitude", "longitude", "event_ts"), order)
    return (
        df.where(F.col("event_ts") < end_ts)
        .groupBy("card_id")
        .agg(
            F.sum(F.when(in30, F.col("amount_usd"))).alias("_s30"),
            F.count(F.when(in30, F.lit(1))).alias("_n30"),
            last.alias("_last"),
            F.count_distinct(F.when(in90, F.col("device_fingerprint"))).alias("devices_90d"),
            F.array_sort(F.collect_set(F.when(in30, F.col("merchant_category")))).alias("merchant_categories_30d"),
        )
        .select(
            "card_id",
            F.when(F.col("_n30") > 0, (F.col("_s30") / F.col("_n30")).cast("decimal(18,4)"))
            .otherwise(F.lit(0).cast("decimal(18,4)")).alias("avg_amount_30d"),
            F.col("_n30").alias("tx_count_30d"),
            F.col("_last.latitude").alias("last_latitude"),
            F.col("_last.longitude").alias("last_longitude"),
            F.col("_last.event_ts").alias("last_tx_timestamp"),
            "devices_90d",
            "merchant_categories_30d",
            F.date_add(end, fixed.PROFILE_TTL_DAYS).alias("expires_on"),
        )
    )


def nightly_avg_amount(tx: DataFrame, days: int = fixed.AMOUNT_WINDOW_DAYS) -> DataFrame:
    """F3 (nightly form): each event gets the 30-day average as of the end
    of the previous day, from a daily per-card pre-aggregate rolled over
    days (one row per card and day in the window) and an equi-join on
    (card, day) - the profile the scorer would have read."""
    df = with_event_ts(tx).withColumn("_day", F.to_date("event_ts"))
    daily = df.groupBy("card_id", "_day").agg(
        F.sum("amount_usd").alias("_ds"), F.count(F.lit(1)).alias("_dn")
    )
    daily = daily.withColumn("_dn_i", F.datediff(F.col("_day"), F.lit("1970-01-01").cast("date")))
    # every event day has its own daily row, so the rolled value at that
    # row (days d - 30 .. d - 1) is the profile the event reads
    roll = Window.partitionBy("card_id").orderBy("_dn_i").rangeBetween(-days, -1)
    prof = daily.select(
        "card_id", "_day",
        F.sum("_ds").over(roll).alias("_rs"),
        F.sum("_dn").over(roll).alias("_rn"),
    )
    j = df.join(prof, ["card_id", "_day"], "left")
    return j.select(
        *tx.columns, "event_ts",
        F.when(F.col("_rn") > 0, (F.col("_rs") / F.col("_rn")).cast("decimal(18,4)"))
        .otherwise(F.lit(0).cast("decimal(18,4)")).alias("avg_amount_nightly"),
    )
