"""Streaming fraud scorer and its sinks.

source -> decode -> keyed card state (velocity, last position, duplicates and
late events told apart) -> stream-static joins with the nightly profile
(30-day amounts, known devices, known categories) -> rule columns -> one
``foreachBatch`` that writes all outputs of the batch.

Every event ends in exactly one place: scored (on time or late, both decided
and audited), duplicates, or the quarantine of undecodable messages.

Outputs lie in ``.../run=R/batch_id=N``, written in overwrite mode: R stands for
the checkpoint and N for the batch, so a replayed batch replaces its own files
and a new checkpoint, whose batches count from 0 again, cannot touch the old
run's. A batch is committed when all its outputs are written (``outputs``: ledger, compaction and
readers). The scorer runs once per event (not once per sink). The profile is either that of one night, joined
in the stream, or a ``ProfileStore`` of nightly versions, resolved by each micro-batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.operators import features, rules
from ordermart.session import hadoop_path, stream_start
from ordermart.streaming import outputs, source, state
from ordermart.streaming.profiles import ProfileStore


def profile_tables(tx: DataFrame, as_of_date: str, date_col: str | None = None) -> dict[str, DataFrame]:
    """M14 as lookup tables for the stream: per card amounts (30 days), and
    long (card, device) / (card, category) tables - sets as rows, so a card
    with many devices is just more rows, never one big array. ``date_col``: a stored
    column with the event's date, by which the night's scan is limited to the longest window (90 days)."""
    if date_col:
        last = F.lit(as_of_date).cast("date")
        tx = tx.where((F.col(date_col) > F.date_sub(last, fixed.DEVICE_WINDOW_DAYS)) & (F.col(date_col) <= last))
    df = features.with_event_ts(tx).withColumn("_d", F.to_date("event_ts"))
    end = F.lit(as_of_date).cast("date")
    upto = df.where(F.col("_d") <= end)
    in30 = F.col("_d") > F.date_sub(end, fixed.AMOUNT_WINDOW_DAYS)
    in90 = F.col("_d") > F.date_sub(end, fixed.DEVICE_WINDOW_DAYS)
    amounts = upto.where(in30).groupBy("card_id").agg(
        F.sum("amount_usd").cast("decimal(28,4)").alias("amount_sum_30d"),
        F.count(F.lit(1)).alias("amount_count_30d"))
    devices = upto.where(in90 & F.col("device_fingerprint").isNotNull()).select(
        "card_id", "device_fingerprint").distinct()
    categories = upto.where(in30 & F.col("merchant_category").isNotNull()).select(
        "card_id", "merchant_category").distinct()
    return {"amounts": amounts, "devices": devices, "categories": categories}


def score_stream(
    tx: DataFrame,
    profile: dict[str, DataFrame],
    blocklist: Sequence[str],
    processed_at: Column | None = None,
    lateness_seconds: int = 600,
    id_memory_seconds: int = 86_400,
    position_ttl_days: int = fixed.PROFILE_TTL_DAYS,
) -> DataFrame:
    """O6 core: decoded transaction stream -> scored stream (plus the
    feature columns, for the audit output, and ``_status``)."""
    st = state.card_velocity_state(
        tx.where(F.col("_decode_ok")), lateness_seconds=lateness_seconds,
        id_memory_seconds=id_memory_seconds, position_ttl_days=position_ttl_days)
    return decide(enrich(st, profile), blocklist, processed_at)


def enrich(st: DataFrame, profile: dict[str, DataFrame]) -> DataFrame:
    """E5: the card state's output with the profile of one night."""
    dev = profile["devices"].select("card_id", "device_fingerprint", F.lit(True).alias("device_seen_90d"))
    cat = profile["categories"].select("card_id", "merchant_category", F.lit(True).alias("category_seen_30d"))
    return (
        st.join(profile["amounts"], "card_id", "left")
        .join(dev, ["card_id", "device_fingerprint"], "left")
        .join(cat, ["card_id", "merchant_category"], "left")
        .withColumn("amount_count_30d", F.coalesce("amount_count_30d", F.lit(0)))
        .withColumn("amount_sum_30d", F.coalesce("amount_sum_30d", F.lit(0).cast("decimal(28,4)")))
    )


def decide(enriched: DataFrame, blocklist: Sequence[str], processed_at: Column | None = None) -> DataFrame:
    """Rule columns, decision and processing time of enriched events."""
    geo = features.geo_speed(enriched)
    decided = rules.decide(rules.blocklist_flag(geo, blocklist))
    ts = processed_at if processed_at is not None else F.current_timestamp()
    return decided.withColumn("processed_at", ts)


def _kv(df: DataFrame) -> DataFrame:
    """key = transaction id, value = JSON of the scored record."""
    return df.select(F.col("transaction_id").alias("key"), F.to_json(F.struct(*rules.SCORED_COLUMNS)).alias("value"))


SCORED_TOPIC = "transactions.scored"
ALERTS_TOPIC = "fraud.alerts"


def stream_run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of a checkpoint, kept beside it: the same for every restart from
    it, a new one when it was lost."""
    fs, path = hadoop_path(spark, f"{checkpoint}/run_id")
    if not fs.exists(path):
        out = fs.create(path, False)
        out.writeUTF(uuid.uuid4().hex[:12])
        out.close()
    into = fs.open(path)
    try:
        return into.readUTF()
    finally:
        into.close()


def fan_out(out_root: str, kafka_bootstrap: str | None = None, kafka_options: dict | None = None, run_id: str = "0", score=None):
    """One batch function, all outputs, idempotent by
    run and batch id, committed when all are written. ``score`` makes the scored rows from the batch (default:
    it holds them). With ``kafka_bootstrap`` the scored and alert records also go
    to their topics (key = transaction id, so consumers de-duplicate a
    replayed batch by key); the file outputs stay the audit of record."""
    def to_topic(kv: DataFrame, topic: str) -> None:
        w = kv.write.format("kafka").option("kafka.bootstrap.servers", kafka_bootstrap).option("topic", topic)
        for k, v in (kafka_options or {}).items():
            w = w.option(k, v)
        w.save()

    def write(batch: DataFrame, batch_id: int) -> None:
        at = f"run={run_id}/batch_id={batch_id}"
        spark = batch.sparkSession
        arrived = batch.persist() if score else None  # the keyed state runs once
        everything = (score(arrived) if score else batch).persist()
        try:
            b = everything.where("_status <> 'duplicate'")
            scored = rules.score_projection(b, F.col("processed_at"))
            _kv(scored).write.mode("overwrite").json(f"{out_root}/scored/{at}")
            _kv(rules.alerts(scored)).write.mode("overwrite").json(f"{out_root}/alerts/{at}")
            everything.where("_status = 'duplicate'").select(
                "transaction_id", "card_id", "event_ts", F.to_date("event_ts").alias("event_date")).write.mode(
                "overwrite").parquet(f"{out_root}/duplicates/{at}")
            if kafka_bootstrap:
                to_topic(_kv(scored), SCORED_TOPIC)
                to_topic(_kv(rules.alerts(scored)), ALERTS_TOPIC)
            audit = b.select(
                "transaction_id", "card_id", "customer_id", "amount_usd", "fraud_decision",
                F.to_json("triggered_rules_list").alias("triggered_rules"), "decision_reason", "processed_at",
                "tx_count_1min", "tx_count_5min", "last_latitude", "last_longitude", "last_tx_timestamp",
                "amount_count_30d", "speed_kmh", (F.col("_status") == "late").alias("is_late"),
                F.to_date("event_ts").alias("event_date"),
            )
            audit.write.mode("overwrite").parquet(f"{out_root}/audit/{at}")
            outputs.commit_batch(spark, out_root, run_id, batch_id)
        finally:
            everything.unpersist()
            if arrived is not None:
                arrived.unpersist()
    return write


def quarantine_undecodable(tx: DataFrame, out_root: str, checkpoint: str, trigger: dict):
    """Undecodable messages go to their own sink; the stream goes on."""
    bad = tx.where(~F.col("_decode_ok")).select("_raw", F.current_timestamp().alias("_quarantine_ts"))
    return (bad.writeStream.format("json").option("path", f"{out_root}/quarantine")
            .option("checkpointLocation", f"{checkpoint}/quarantine").trigger(**trigger).start())


def run_fraud_stream(
    spark: SparkSession,
    out_root: str,
    checkpoint: str,
    profile: dict[str, DataFrame] | ProfileStore,
    blocklist: Sequence[str],
    path: str | None = None,
    bootstrap: str | None = None,
    trigger: dict | None = None,
    max_per_trigger: int = fixed.MAX_RECORDS_PER_TRIGGER,
    max_files_per_trigger: int | None = None,
    processed_at: Column | None = None,
    lateness_seconds: int = 600,
    id_memory_seconds: int = 86_400,
    position_ttl_days: int = fixed.PROFILE_TTL_DAYS,
    max_future: str = "1 day",
    state_partitions: int | None = None,
):
    """Start the scorer; returns the running query (and the quarantine
    query). ``trigger`` defaults to the 500 ms processing-time trigger and
    ``max_per_trigger`` caps the records of a micro-batch (files:
    ``max_files_per_trigger``). ``state_partitions`` fixes the number of
    keyed-state partitions for the life of the checkpoint: name it on a
    cluster, its default, the parallelism at the start, counts only executors
    that have registered by then."""
    trig = trigger or {"processingTime": fixed.TRIGGER_INTERVAL}
    tx = source.reject_future(source.read_transactions(
        spark, path=path, bootstrap=bootstrap, max_per_trigger=max_per_trigger,
        max_files_per_trigger=max_files_per_trigger), max_future)
    score = None
    if isinstance(profile, ProfileStore):  # resolved by each micro-batch
        scored = state.card_velocity_state(
            tx.where(F.col("_decode_ok")), lateness_seconds=lateness_seconds,
            id_memory_seconds=id_memory_seconds, position_ttl_days=position_ttl_days)
        score = lambda batch: decide(profile.enrich(batch), blocklist, processed_at)
    else:
        scored = score_stream(tx, profile, blocklist, processed_at, lateness_seconds, id_memory_seconds, position_ttl_days)
    run = stream_run_id(spark, checkpoint)
    with stream_start(spark, state_partitions):
        q = (scored.writeStream.foreachBatch(fan_out(out_root, bootstrap, run_id=run, score=score))
             .option("checkpointLocation", f"{checkpoint}/scorer").trigger(**trig).start())
        qq = quarantine_undecodable(tx, out_root, checkpoint, trig)
    return q, qq


def velocity_windows(tx: DataFrame, id_memory_seconds: int = 86_400) -> tuple[DataFrame, DataFrame]:
    """Per micro-batch, counts of a card's events per tumbling minute and
    per sliding five minutes (one-minute slide), by event time.

    The counts are partial: a window's value is the sum over batches
    (:func:`window_totals`), so an event counts however late it comes, and
    nothing is held in memory for windows. Duplicates are left out by the
    id memory."""
    once = state.known_ids(tx.where(F.col("_decode_ok")), id_memory_seconds).where("NOT _again")
    minute = F.window("event_ts", "1 minute")
    five = F.window("event_ts", "5 minutes", "1 minute")
    flat = lambda w: once.select("card_id", w.alias("w")).select(
        "card_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    return flat(minute), flat(five)


def write_window_counts(out_root: str, run_id: str = "0"):
    """J9 sink: each batch's partial counts per card and window, committed like the scorer's outputs."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("card_id", "window_start", "window_end").agg(F.count("*").alias("tx_count"))
         .withColumn("event_date", F.to_date("window_start"))
         .write.mode("overwrite").parquet(f"{out_root}/windows/run={run_id}/batch_id={batch_id}"))
        outputs.commit_batch(batch.sparkSession, out_root, run_id, batch_id)
    return write


def window_totals(spark: SparkSession, out_root: str) -> DataFrame:
    """Current counts: those folded so far and the partial counts of the batches since, added up."""
    return outputs.read_output(spark, out_root, "windows").drop("event_date")


def fold_windows(spark: SparkSession, out_root: str) -> int:
    """Fold the partial counts of all committed batches into the base table; counts that come
    later, of whatever window, are added by the next fold. Returns the batches folded."""
    return outputs.compact(spark, out_root, "windows")
