"""Merges by partition, numeric version order, linear windows, late events."""

import json
import os
import time

from pyspark.sql import functions as F

from ordermart.operators import change, clean, marts
from ordermart.operators.fraud_windows import trailing_counts, trailing_stats
from ordermart.session import scratch_path
from ordermart.sinks import lake as sink
from ordermart.sources import lake

def rows(spark, *values):
    return spark.createDataFrame(list(values), "order_id string, order_status string, updated string, "
                                 "_kafka_timestamp_ms string, order_date string").select(
        "order_id", "order_status", F.col("updated").cast("timestamp").alias("order_updated_at"),
        "_kafka_timestamp_ms", "order_date")


def stored(spark, root):
    return sorted((r.order_id, r.order_status, str(r.order_date)) for r in lake.read_history(spark, root).collect())


def files(root):
    top = root.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), top) for d, _, names in os.walk(top) for f in names if f.startswith("part-")}


def test_older_run_keeps_newer_rows_and_keys_leave_old_dates(spark):
    root = scratch_path(spark, "merge")
    newer = rows(spark, ("A", "delivered", "2024-03-16 10:00:00", "9", "2024-03-15"), ("B", "pending", "2024-03-15 10:00:00", "9", "2024-03-15"),
                 ("C", "pending", "2024-03-10 10:00:00", "9", "2024-03-10"), ("D", "pending", "2024-03-11 10:00:00", "9", "2024-03-11"))
    sink.write_silver(newer, root)
    untouched = {f for f in files(root) if "2024-03-10" in f}
    older = rows(spark, ("A", "pending", "2024-03-15 09:00:00", "9", "2024-03-15"))
    moved = rows(spark, ("D", "shipped", "2024-03-17 09:00:00", "9", "2024-03-15"))  # its date becomes empty
    for updates in (older, moved, moved):
        sink.write_silver(updates, root)
    assert stored(spark, root) == [("A", "delivered", "2024-03-15"), ("B", "pending", "2024-03-15"),
                                   ("C", "pending", "2024-03-10"), ("D", "shipped", "2024-03-15")]
    assert {f for f in files(root) if "2024-03-10" in f} == untouched and not any("2024-03-11" in f for f in files(root))


def test_broker_times_compare_as_numbers(spark):
    schema = "order_id string, _cdc_operation string, _kafka_timestamp_ms string"
    events = spark.createDataFrame([("A", "u", "999999999999"), ("A", "d", "1000000000000"), ("B", "d", "999999999999"),
                                    ("B", "u", "1000000000000"), ("C", "u", "5"), ("C", "d", "5")], schema)
    assert sorted(r.order_id for r in change.latest_deletes(events).collect()) == ["A", "C"]
    versions = rows(spark, ("A", "old", "2024-01-01 00:00:00", "999999999999", "d"), ("A", "new", "2024-01-01 00:00:00", "1000000000000", "d"))
    for method in ("aggregate", "window"):
        assert clean.latest_per_key(versions, method=method).first().order_status == "new"


def test_bad_customer_text_does_not_fail_the_job(spark):
    src = spark.createDataFrame([("1", "true", "2024-01-01", "1990-13-45"), ("2", "perhaps", "soon", None)],
                                "customer_id string, is_email_verified string, created_at string, date_of_birth string")
    src = src.select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "email", "first_name", "last_name", "country_code", "acquisition_channel", "customer_tier", "is_marketing_opted_in",
        "updated_at", "_ingested_at")])
    assert marts.stage_customers(src).where("date_of_birth IS NULL").count() == 2
    assert {r.customer_id: r._unparsable for r in marts.unparsable_customers(src).collect()} == {
        "1": ["date_of_birth"], "2": ["is_email_verified", "created_at"]}


def test_windows_of_a_hot_key_are_linear(spark):
    def seconds(n):
        df = spark.range(n).select(F.lit("hot").alias("k"), F.timestamp_micros(
            F.lit(1_700_000_400_000_000) + F.col("id") * F.lit(3_000_000_000 // n)).alias("ts"), F.lit(1).cast("decimal(10,2)").alias("v"))
        start = time.perf_counter()
        trailing_counts(df, ["k"], "ts", {"c1": 60, "c5": 300}).write.format("noop").mode("overwrite").save()
        trailing_stats(df, ["k"], "ts", 7200, 3600, {"v": F.col("v")}).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(20_000)
    small, large = seconds(100_000), seconds(400_000)
    assert large <= 5 * small + 1


def line(i, t, card="A"):
    return json.dumps({"transaction_id": f"T{i}", "card_id": card, "customer_id": "U", "merchant_id": "M", "amount_usd": 10.0,
                       "currency": "USD", "merchant_category": "web", "device_fingerprint": "D", "ip_address": "1", "latitude": 40.0,
                       "longitude": 0.0, "event_time": t})


def test_late_events_and_a_long_gap(spark):
    from ordermart.streaming import scorer

    root = scratch_path(spark, "late")
    local = root.removeprefix("file:")
    spark.createDataFrame([("Z", "B", "U", "M", "web", "D", 1.0, 1.0, "2023-12-31T00:00:00.000000Z")],
                          "transaction_id string, card_id string, customer_id string, merchant_id string, merchant_category string, "
                          "device_fingerprint string, latitude double, longitude double, event_time string").withColumn(
        "amount_usd", F.lit(5).cast("decimal(18,4)")).write.parquet(f"{root}/history")
    profile = scorer.profile_tables(spark.read.parquet(f"{root}/history"), "2023-12-31")
    landings = [
        [line(1, "2024-01-01T10:00:00.000000Z"), line(2, "2024-01-01T10:00:20.000000Z")],
        [line(3, "2024-01-01T09:15:00.000000Z"), line(2, "2024-01-01T10:00:20.000000Z")],          # 45 minutes late, replay
        [line(4, "2024-03-15T10:00:00.000000Z"), line(5, "2999-01-01T00:00:00.000000Z"), "{"],      # 74 days on, far future, junk
        [line(6, "2024-03-15T10:00:10.000000Z")],
    ]
    for i, lines in enumerate(landings):
        os.makedirs(f"{local}/in/b{i}")
        with open(f"{local}/in/b{i}/part.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        for q in scorer.run_fraud_stream(spark, f"{root}/out", f"{root}/ck", profile, [], path=f"{root}/in/b*",
                                         trigger={"availableNow": True}):
            q.awaitTermination()
            assert q.exception() is None
    audit = {r.transaction_id: r for r in spark.read.parquet(f"{root}/out/audit").collect()}
    assert sorted(audit) == ["T1", "T2", "T3", "T4", "T6"]
    assert [t for t in sorted(audit) if audit[t].is_late] == ["T3"]
    assert audit["T2"].tx_count_1min == 1 and audit["T4"].tx_count_1min == 0 and audit["T6"].tx_count_1min == 1
    assert str(audit["T4"].last_tx_timestamp) == "2024-01-01 10:00:20"
    assert [r.transaction_id for r in spark.read.parquet(f"{root}/out/duplicates").collect()] == ["T2"]
    assert spark.read.schema("_raw string").json(f"{root}/out/quarantine").count() == 2
    assert spark.read.json(f"{root}/out/scored").select("run").distinct().count() == 1
