"""End-to-end jobs (O1-O5): layers hand over through Parquet folders only.

Each job is what a scheduler step would run: read its input folder, apply
the layer's operators, gate on quality and on the accounting of its rows,
write. Rows are counted while they are written (observations), not in passes of their own. A frame that a gate and a write both read is cut to a table in the shared
folder, which is deleted when the job has ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermart.functions import fixed
from ordermart.schemas import CDC_REJECTS, RUN_METRICS
from ordermart.session import cut_lineage, discard_cut
from ordermart.operators import bronze, change, clean, gold, marts, quality
from ordermart.sinks import lake as sink
from ordermart.sinks.versions import VersionedTable, part_name, replace_table, table_exists
from ordermart.sources import cdc, lake


@dataclass
class LakePaths:
    landing: str
    bronze: str
    quarantine: str
    silver: str
    silver_quarantine: str
    gold: str
    export: str
    marts: str
    snapshots: str
    rejects: str
    metrics: str

    @classmethod
    def under(cls, root: str) -> "LakePaths":
        return cls(*(f"{root}/{n}" for n in (
            "landing", "bronze", "quarantine/bronze", "silver", "quarantine/silver",
            "gold/customer_ltv", "export/customer_ltv_latest", "marts", "snapshots/customers", "rejects/bronze",
            "metrics")))


def run_bronze(spark: SparkSession, p: LakePaths, run_date: str, ingested_at: str | None = None,
               expected_rows: int = 0, source: str | None = None, trailing: int = 7) -> int:
    """O1: A1 -> C2 -> (B4) -> C1 -> L12 -> B1. Returns rows written. ``source``: the
    folder of this run's landing (default: the one landing folder).

    Every line of the landing ends in exactly one table: Bronze, the corrupt
    quarantine, or the rejects (deletes, NULL and unknown operations, with
    their reason), each in the folder of the run date, so a rerun replaces all three. The rows
    written are held against the lines read. The volume is held against ``expected_rows``, or
    without it against the mean of the last ``trailing`` runs that passed; the measures of each
    run, passed or not, are kept."""
    counts = bronze.accounting_counts()
    keys = ["order_id", "customer_id"]
    kept = F.col("_corrupt_record").isNull() & F.coalesce(F.col("op").isin(list(fixed.CDC_KEEP_OPS)), F.lit(False))
    nulls = {f"null_{k}": F.count_if(kept & F.col(f"after.{k}").isNull()) for k in keys}
    read, seen = quality.counted(cdc.read_cdc_json(spark, source or p.landing), **counts, **nulls,
                                 newest_ts_ms=F.max(F.when(kept, F.expr("try_cast(ts_ms AS bigint)"))))
    landed = cut_lineage(read)  # parsed once, counted on the way, read by each branch
    totals = seen.get
    if expected_rows <= 0:
        expected_rows = expected_volume(spark, p, "bronze", run_date, trailing)
    failed = [f"no_nulls:{k}" for k in keys if totals[f"null_{k}"]] + ["not_empty"] * (totals["kept_rows"] == 0)
    if expected_rows > 0 and abs(totals["kept_rows"] - expected_rows) / expected_rows > fixed.BRONZE_VOLUME_TOLERANCE:
        failed.append("volume_anomaly")
    sink.write_run_metrics(spark, p.metrics, "bronze", run_date, {
        "input_rows": totals["input_rows"], "kept_rows": totals["kept_rows"], "rejected_rows": totals["input_rows"] - totals["kept_rows"],
        "null_keys": sum(totals[f"null_{k}"] for k in keys), "newest_ts_ms": totals["newest_ts_ms"], "passed": not failed})
    parsed, corrupt = cdc.split_corrupt(landed, persist=False)
    written = {"corrupt_rows": sink.quarantine_corrupt(corrupt, p.quarantine, run_date, ingested_at),
               "rejected_rows": sink.write_rejects(bronze.op_rejects(parsed), p.rejects, run_date)}
    if failed:
        raise ValueError("Data quality checks failed for 'bronze_orders': " + ", ".join(failed))
    written["kept_rows"] = sink.write_bronze(bronze.flatten_envelope(parsed, run_date, ingested_at), p.bronze, run_date)
    if sum(written.values()) != totals["input_rows"]:
        raise ValueError(f"Bronze accounting does not balance: read {totals}, written {written}")
    discard_cut(landed)
    return written["kept_rows"]


def run_metrics(spark: SparkSession, p: LakePaths) -> DataFrame:
    """The measures of all runs (layer, run_date and :data:`schemas.RUN_METRICS`)."""
    schema = StructType([*RUN_METRICS.fields, StructField("layer", StringType()), StructField("run_date", StringType())])
    if not lake.path_exists(spark, p.metrics):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(p.metrics)


def expected_volume(spark: SparkSession, p: LakePaths, layer: str, run_date: str, trailing: int) -> float:
    """Mean rows kept by the last ``trailing`` passed runs before ``run_date``; 0 without any."""
    before = run_metrics(spark, p).where((F.col("layer") == layer) & (F.col("run_date") < str(run_date)) & F.col("passed"))
    last = before.orderBy(F.col("run_date").desc()).limit(trailing)
    return last.agg(F.coalesce(F.avg("kept_rows"), F.lit(0.0))).first()[0]


def bronze_written(spark: SparkSession, p: LakePaths, run_date: str, source: str | None = None) -> DataFrame:
    """L13 over the stored tables of a run: lines landed against rows of
    Bronze, of the corrupt quarantine and of the rejects of its date."""
    rejects = spark.read.schema(CDC_REJECTS).parquet(f"{p.rejects}/reject_date={run_date}")
    parts = [
        spark.read.text(source or p.landing).agg(F.count("*").alias("n")).select(F.lit("input_rows").alias("part"), "n"),
        spark.read.schema("_raw_record string").json(f"{p.quarantine}/quarantine_date={run_date}").agg(
            F.count("*").alias("n")).select(F.lit("corrupt_rows"), "n"),
        lake.read_partition(spark, p.bronze, run_date).agg(F.count("*").alias("n")).select(F.lit("kept_rows"), "n"),
        rejects.agg(F.count_if(F.col("_reject_reason") == "delete_event").alias("n")).select(F.lit("deleted_rows"), "n"),
        rejects.agg(F.count_if(F.col("_reject_reason") != "delete_event").alias("n")).select(F.lit("unknown_op_rows"), "n")]
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.union(other)
    names = ["input_rows", "corrupt_rows", "kept_rows", "deleted_rows", "unknown_op_rows"]
    wide = rows.agg(*[F.max(F.when(F.col("part") == c, F.col("n"))).alias(c) for c in names])
    return wide.withColumn("balanced", F.col(names[0]) == sum((F.col(c) for c in names[2:]), F.col(names[1])))


def run_silver(spark: SparkSession, p: LakePaths, run_date: str, deletes: bool = False) -> DataFrame:
    """O2: A2 -> C3 -> C4 (+B5) -> F1 -> E4 -> C8 -> L13 -> L12 -> B2 (latest
    version per key, in the dates touched). With ``deletes`` the keys whose
    latest change of the run is a delete event leave Silver (X24). Returns
    the stored table."""
    src = lake.read_partition(spark, p.bronze, run_date).drop("ingestion_date")
    reason = F.col("_quarantine_reason")
    read, seen = quality.counted(
        clean.cast_and_normalise(src).withColumn("_quarantine_reason", clean.invalid_reason()),
        input_rows=F.count(F.lit(1)), valid_rows=F.count_if(reason.isNull()), rejected_rows=F.count_if(reason.isNotNull()))
    tagged = cut_lineage(read)
    totals = seen.get
    rejected = sink.quarantine_invalid(tagged.where(reason.isNotNull()), p.silver_quarantine, run_date)
    if totals["input_rows"] != totals["valid_rows"] + rejected:
        raise ValueError(f"Silver accounting does not balance: {totals}, {rejected} rows quarantined")
    valid = tagged.where(reason.isNull()).drop("_quarantine_reason")
    latest = clean.derive_order_flags(clean.fx_lookup(clean.latest_per_key(valid)))
    suite = (quality.QualitySuite(latest, "silver_orders").not_empty()
             .no_nulls(["order_id", "customer_id", "order_date", "order_total_usd"])
             .unique(["order_id"]).accepted_values("order_status", fixed.VALID_ORDER_STATUSES))
    silver = suite.measure(cut_lineage)
    quality.gate(silver, suite)
    sink.write_silver(silver, p.silver)
    if deletes:
        drop_deleted(spark, p, run_date)
    discard_cut(tagged, silver)
    return lake.read_history(spark, p.silver)


def drop_deleted(spark: SparkSession, p: LakePaths, run_date: str) -> None:
    """Rewrite the dates of Silver that hold keys whose latest change of
    the run is a delete event, without them."""
    gone = spark.read.schema(CDC_REJECTS).parquet(f"{p.rejects}/reject_date={run_date}").where(F.col("op") == "d").select(
        F.col("after.order_id").alias("order_id"), F.col("op").alias("_cdc_operation"),
        F.col("ts_ms").alias("_kafka_timestamp_ms"))
    kept = lake.read_partition(spark, p.bronze, run_date).select("order_id", "_cdc_operation", "_kafka_timestamp_ms")
    keys = cut_lineage(change.latest_deletes(kept.unionByName(gone)))
    sink.delete_from_partitions(keys, p.silver, "order_id", "order_date")
    discard_cut(keys)


def run_gold(spark: SparkSession, p: LakePaths, as_of: str) -> DataFrame:
    """O3: A3 -> D5 + N1 -> L12 -> B3. Returns the latest copy as read back."""
    metrics = gold.compute_ltv_metrics(lake.read_history(spark, p.silver), as_of)
    suite = (quality.QualitySuite(metrics, "gold_customer_ltv").not_empty()
             .no_nulls(["customer_id", "total_orders", "ltv_segment"]).unique(["customer_id"])
             .accepted_values("ltv_segment", fixed.LTV_SEGMENTS))
    ltv = suite.measure(cut_lineage)
    quality.gate(ltv, suite)
    sink.write_snapshot_and_latest(ltv, p.gold, p.export, as_of)
    discard_cut(ltv)
    return lake.read_history(spark, p.export)


def mart_registry(spark: SparkSession, p: LakePaths, customers_src: DataFrame, as_of_ts: str) -> lake.SourceRegistry:
    """Sources by logical name and models reading each other by
    name (each ``ref`` is a lazy DataFrame, also registered as a view)."""
    reg = lake.SourceRegistry(spark)
    reg.register_path("silver_orders", p.silver)
    reg.register_path("customer_ltv_gold", p.export)
    reg.register("silver_customers", lambda r: customers_src)
    reg.register("stg_orders", lambda r: marts.stage_orders(r.ref("silver_orders")))
    reg.register("stg_customers", lambda r: marts.stage_customers(r.ref("silver_customers")))
    reg.register("int_orders_enriched", lambda r: marts.enrich_orders(r.ref("stg_orders"), r.ref("stg_customers")))
    reg.register("fct_orders_source", lambda r: marts.fct_orders(r.ref("int_orders_enriched"), as_of_ts))
    return reg


def run_marts(spark: SparkSession, p: LakePaths, customers_src: DataFrame, as_of: str, as_of_ts: str,
              lookback_column: str = "order_date") -> dict[str, str]:
    """C6, C7 -> E2 -> C11 -> B8 (fact, merged by order_id into the dates
    touched); E3 (dimension); D6 (finance). Returns the written paths.

    ``lookback_column``: what the incremental look-back compares with the
    stored maximum. ``order_date`` takes in recent orders; ``order_updated_at``
    also orders of any date that were corrected since."""
    reg = mart_registry(spark, p, customers_src, as_of_ts)
    fct_new = reg.ref("fct_orders_source")
    fct_path = f"{p.marts}/fct_orders"
    since = None
    if table_exists(spark, fct_path):  # a partition column: from the folder names
        from_names = lookback_column == "order_date"
        since = (lake.newest_value(spark, fct_path, lookback_column) if from_names
                 else change.read_target_watermark(lake.read_history(spark, fct_path), lookback_column))
    sink.merge_into_partitions(change.incremental_lookback(fct_new, since, column=lookback_column),
                               fct_path, "order_id", "order_date")
    reg.register_path("fct_orders", fct_path)
    paths = {"fct_orders": fct_path, "dim_customers": f"{p.marts}/dim_customers",
             "revenue_summary": f"{p.marts}/revenue_summary"}
    dim = marts.dim_customers(reg.ref("stg_customers"), reg.ref("customer_ltv_gold"), as_of, as_of_ts)
    replace_table(dim, paths["dim_customers"])
    replace_table(marts.revenue_summary(reg.ref("fct_orders"), as_of_ts), paths["revenue_summary"])
    return paths


def run_snapshot(spark: SparkSession, p: LakePaths, source: DataFrame, run_ts: str) -> DataFrame:
    """C7 -> E7. One snapshot step: only the open versions are read and
    replaced; versions that close are added to the closed history, which is
    never rewritten. Returns the whole history.

    Open and closed versions are parts of one versioned table, so one commit moves a version from one
    to the other; a step that failed anywhere runs again from the history before it."""
    table = VersionedTable(spark, p.snapshots)
    base = table.head()
    if base is None:  # first run
        step = change.scd2_initial(source)
        names = []
    else:
        names = [part_name("scd_part", "open")]
        step = change.scd2_apply(table.read(names, base).drop("scd_part"), source, run_ts)
    closed = f"closed-{(base.number if base else 0) + 1:09d}"
    table.write(step.withColumn("scd_part", F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit(closed))),
                "scd_part", base, names)
    return table.read().drop("scd_part")
