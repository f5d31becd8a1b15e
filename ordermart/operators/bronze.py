"""Bronze operators: flatten the CDC envelope (C1) and route rows that must
not silently vanish (delete and unknown operations) to a reject branch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.schemas import ORDER_FIELDS


def flatten_envelope(
    cdc: DataFrame,
    run_date: str,
    ingested_at: Column | str | None = None,
    keep_ops: Sequence[str] = fixed.CDC_KEEP_OPS,
    source_system: str = fixed.SOURCE_SYSTEM,
) -> DataFrame:
    """Keep create / update / snapshot-read events, lift ``after.*`` to
    top level (values stay strings) and add the five audit columns.
    ``ingested_at`` defaults to the current timestamp; pass a literal to make
    reruns repeatable."""
    if ingested_at is None:
        ts = F.current_timestamp()
    elif isinstance(ingested_at, Column):
        ts = ingested_at
    else:
        ts = F.lit(ingested_at).cast("timestamp")
    return cdc.where(F.col("op").isin(list(keep_ops))).select(
        *[F.col(f"after.{c}").alias(c) for c in ORDER_FIELDS],
        F.col("op").alias("_cdc_operation"),
        F.col("ts_ms").alias("_kafka_timestamp_ms"),
        F.lit(str(run_date)).alias("_ingestion_date"),
        ts.alias("_ingested_at"),
        F.lit(source_system).alias("_source_system"),
    )


def op_rejects(cdc: DataFrame, keep_ops: Sequence[str] = fixed.CDC_KEEP_OPS) -> DataFrame:
    """Events the flatten step does not keep, with a reason: deletes
    (tombstones) and NULL / unknown operations, which would otherwise
    disappear without trace."""
    op = F.col("op")
    return cdc.where(~F.coalesce(op.isin(list(keep_ops)), F.lit(False))).withColumn(
        "_reject_reason",
        F.when(op == "d", F.lit("delete_event")).when(op.isNull(), F.lit("null_op")).otherwise(F.lit("unknown_op")),
    )


def accounting_counts(corrupt_col: str = "_corrupt_record", keep_ops: Sequence[str] = fixed.CDC_KEEP_OPS) -> dict[str, Column]:
    """L13 for Bronze: what the lines of a landing are, as aggregates."""
    op = F.col("op")
    ok = F.col(corrupt_col).isNull()
    kept = ok & F.coalesce(op.isin(list(keep_ops)), F.lit(False))
    return {
        "input_rows": F.count(F.lit(1)),
        "corrupt_rows": F.count_if(~ok),
        "kept_rows": F.count_if(kept),
        "deleted_rows": F.count_if(ok & (op == "d")),
        "unknown_op_rows": F.count_if(ok & ~F.coalesce(op.isin(list(keep_ops) + ["d"]), F.lit(False))),
    }


def bronze_accounting(raw: DataFrame, corrupt_col: str = "_corrupt_record",
                      keep_ops: Sequence[str] = fixed.CDC_KEEP_OPS) -> DataFrame:
    """L13 for Bronze: lines in = corrupt + kept + deletes + NULL/unknown op,
    from one aggregate."""
    out = raw.agg(*[c.alias(name) for name, c in accounting_counts(corrupt_col, keep_ops).items()])
    return out.withColumn(
        "balanced",
        F.col("input_rows") == F.col("corrupt_rows") + F.col("kept_rows") + F.col("deleted_rows") + F.col("unknown_op_rows"),
    )
