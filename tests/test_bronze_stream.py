import json
import os

from pyspark.sql import functions as F

from ordermart.operators import bronze
from ordermart.session import scratch_path
from ordermart.sources import cdc


def test_corrupt_split_and_ops(spark):
    path = scratch_path(spark, "cdc-test").removeprefix("file:")
    os.makedirs(path)
    after = {"order_id": "O1", "customer_id": "C1"}
    lines = [json.dumps({"op": op, "ts_ms": "1", "after": after}) for op in ["c", "u", "r", "d"]]
    lines += [json.dumps({"ts_ms": "1", "after": after}), '{"op": "c", "after": {']
    with open(f"{path}/part.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = cdc.read_cdc_json(spark, path)
    parsed, corrupt = cdc.split_corrupt(raw)
    assert corrupt.count() == 1 and parsed.count() == 5
    flat = bronze.flatten_envelope(parsed, "2024-01-01", "2024-01-01 01:00:00")
    assert sorted(r["_cdc_operation"] for r in flat.collect()) == ["c", "r", "u"]
    rej = {r["_reject_reason"] for r in bronze.op_rejects(parsed).collect()}
    assert rej == {"delete_event", "null_op"}
    acc = bronze.bronze_accounting(raw).first()
    assert (acc["input_rows"], acc["corrupt_rows"], acc["kept_rows"], acc["deleted_rows"], acc["unknown_op_rows"],
            acc["balanced"]) == (6, 1, 3, 1, 1, True)


def _tx_line(i, card, t, lat=40.0):
    return json.dumps({"transaction_id": f"T{i}", "card_id": card, "customer_id": "U", "merchant_id": "M",
                       "amount_usd": 10.0, "currency": "USD", "merchant_category": "web", "device_fingerprint": "D",
                       "ip_address": "1", "latitude": lat, "longitude": 0.0, "event_time": t})


def test_stream_state_late_duplicate_restart(spark):
    from ordermart.session import stream_start
    from ordermart.streaming import scorer, source

    root = scratch_path(spark, "stream-test").removeprefix("file:")
    # the profile is a stored table, as the nightly refresh writes it (with a
    # small *local* frame as the static side, Spark 4.1 fails to convert the
    # Arrow rows of the state operator in the joined plan)
    hist = spark.createDataFrame([("Z", "B", "U", "M", 5.0, "web", "D", 1.0, 1.0, "2023-12-31T00:00:00.000000Z")],
                                 "transaction_id string, card_id string, customer_id string, merchant_id string, "
                                 "amount_usd double, merchant_category string, device_fingerprint string, "
                                 "latitude double, longitude double, event_time string")
    hist.withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,4)")).write.parquet(f"{root}/history")
    profile = scorer.profile_tables(spark.read.parquet(f"{root}/history"), "2023-12-31")
    batches = [
        [_tx_line(1, "A", "2024-01-01T00:00:00.000000Z"), _tx_line(2, "A", "2024-01-01T00:00:30.000000Z"),
         _tx_line(3, "A", "2024-01-01T00:00:50.000000Z")],
        [_tx_line(4, "A", "2024-01-01T00:01:10.000000Z"), _tx_line(2, "A", "2024-01-01T00:00:30.000000Z"),  # duplicate
         _tx_line(5, "A", "2024-01-01T00:00:40.000000Z", lat=-30.0), "not json"],                            # late, junk
    ]
    for i, lines in enumerate(batches):
        os.makedirs(f"{root}/in/b{i}")
        with open(f"{root}/in/b{i}/part.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        tx = source.read_transactions(spark, path=f"{root}/in/b*")
        with stream_start(spark, None):
            q = (scorer.score_stream(tx, profile, [], F.lit("2024-01-02").cast("timestamp"))
                 .writeStream.foreachBatch(scorer.fan_out(f"{root}/out")).option("checkpointLocation", f"{root}/ck")
                 .trigger(availableNow=True).start())
        q.awaitTermination()
    a = {r["transaction_id"]: r for r in spark.read.parquet(f"{root}/out/audit").collect()}
    assert sorted(a) == ["T1", "T2", "T3", "T4", "T5"]          # duplicate T2 dropped, junk not scored
    # T5 (00:00:40) arrives late but in the same batch as T4, so T4 sees it
    assert [a[t]["tx_count_1min"] for t in ["T1", "T2", "T3", "T4"]] == [0, 1, 2, 3]
    assert a["T5"]["tx_count_1min"] == 2                           # late: counts known at arrival (T1, T2)
    assert a["T4"]["last_tx_timestamp"].isoformat().startswith("2024-01-01T00:00:50")
    scored = spark.read.json(f"{root}/out/scored")
    assert scored.count() == 5 and set(scored.columns) == {"key", "value", "run", "batch_id"}


def test_run_fraud_stream_end_to_end(spark):
    """The full entry point (decode, guard, state, profile joins, fan-out
    and the quarantine of undecodable messages) on a file source."""
    from ordermart.streaming import scorer

    root = scratch_path(spark, "o6").removeprefix("file:")
    os.makedirs(f"{root}/in")
    with open(f"{root}/in/part.txt", "w") as f:
        f.write("\n".join([_tx_line(i, "A", f"2024-01-01T00:00:{i:02d}.000000Z") for i in range(1, 8)]
                          + ["{broken", _tx_line(99, "M", "2024-01-01T00:00:09.000000Z")]) + "\n")
    hist = spark.createDataFrame([("Z", "A", "U", "M", 5.0, "web", "D", 40.0, 0.0, "2023-12-31T00:00:00.000000Z")],
                                 "transaction_id string, card_id string, customer_id string, merchant_id string, "
                                 "amount_usd double, merchant_category string, device_fingerprint string, "
                                 "latitude double, longitude double, event_time string")
    hist.withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,4)")).write.parquet(f"{root}/history")
    profile = scorer.profile_tables(spark.read.parquet(f"{root}/history"), "2023-12-31")
    q, qq = scorer.run_fraud_stream(spark, f"{root}/out", f"{root}/ck", profile, ["M-X"], path=f"{root}/in",
                                    trigger={"availableNow": True})
    q.awaitTermination()
    qq.awaitTermination()
    scored = spark.read.json(f"{root}/out/scored")
    decisions = {r["key"]: json.loads(r["value"])["fraud_decision"] for r in scored.collect()}
    assert len(decisions) == 8
    assert decisions["T6"] == "BLOCK" and decisions["T7"] == "BLOCK"   # 5 and 6 earlier events in 60 s
    assert decisions["T1"] == "PASS"
    alerts = spark.read.json(f"{root}/out/alerts").count()
    assert alerts == sum(1 for d in decisions.values() if d != "PASS")
    assert spark.read.json(f"{root}/out/quarantine").count() == 1


def test_admission_control_splits_batches(spark):
    """A5: at most one new file per micro-batch (the file-source form of the
    per-trigger record cap), so two landed files make two batches."""
    from ordermart.streaming import scorer

    root = scratch_path(spark, "a5").removeprefix("file:")
    os.makedirs(f"{root}/in")
    for i in range(2):
        with open(f"{root}/in/part{i}.txt", "w") as f:
            f.write(_tx_line(10 + i, "A", f"2024-01-01T00:0{i}:00.000000Z") + "\n")
    spark.createDataFrame([("Z", "A", "U", "M", "web", "D", 1.0, 1.0, "2023-12-31T00:00:00.000000Z")],
                          "transaction_id string, card_id string, customer_id string, merchant_id string, "
                          "merchant_category string, device_fingerprint string, latitude double, longitude double, "
                          "event_time string").withColumn("amount_usd", F.lit(5).cast("decimal(18,4)")).write.parquet(
        f"{root}/history")
    profile = scorer.profile_tables(spark.read.parquet(f"{root}/history"), "2023-12-31")
    q, qq = scorer.run_fraud_stream(spark, f"{root}/out", f"{root}/ck", profile, [], path=f"{root}/in",
                                    trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    qq.awaitTermination()
    batches = {r["batch_id"] for r in spark.read.parquet(f"{root}/out/audit").select("batch_id").collect()}
    assert len(batches) == 2
