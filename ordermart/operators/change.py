"""Change application: target watermark, incremental lookback, merge by key,
SCD2 history and as-of lookups (A8, C12, B8, E6, E7, F7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.operators.fraud_windows import keyed_as_of, keyed_lag_lead


def read_target_watermark(target: DataFrame | None, column: str = "order_date"):
    """``max(column)`` of the target as a Python scalar (one row
    from one aggregate), or None for a first (full) load. Passing it on as a
    literal lets the source scan prune partitions."""
    if target is None:
        return None
    return target.agg(F.max(column).alias("m")).first()["m"]


def incremental_lookback(
    source: DataFrame,
    watermark,
    days: int = fixed.INCREMENTAL_LOOKBACK_DAYS,
    column: str = "order_date",
) -> DataFrame:
    """Rows on or after ``watermark - days``; everything when there is
    no watermark (first run)."""
    if watermark is None:
        return source
    return source.where(F.col(column) >= F.date_sub(F.lit(str(watermark)).cast("date"), days))


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str] = "order_id",
    delete_flag: str | None = None,
) -> DataFrame:
    """Matched keys take the update row, unmatched updates are
    inserted, untouched target rows stay. One anti join on the key (shuffle
    by key, AQE may broadcast a small update set) and a union; rerunning with
    the same updates gives the same table. With ``delete_flag`` set, update
    rows flagged true remove their key instead."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    ups = updates
    if delete_flag is not None:
        ups = ups.where(~F.coalesce(F.col(delete_flag), F.lit(False))).drop(delete_flag)
    return kept.unionByName(ups.select(target.columns))


def latest_deletes(changes: DataFrame, key: str = "order_id", op: str = "_cdc_operation",
                   order_by: Sequence[str] = ("try_cast(_kafka_timestamp_ms AS bigint)",)) -> DataFrame:
    """Keys whose latest change event is a delete (one aggregate with
    map-side partial aggregation, no per-key sort). Broker times are compared
    as numbers; of events at the same time a delete counts as the later."""
    ranks = F.struct(*[F.expr(c) for c in order_by], (F.col(op) == "d").alias("_d"))
    latest = changes.groupBy(key).agg(F.max_by(F.col(op), ranks).alias("_op"))
    return latest.where(F.col("_op") == "d").select(key)


def apply_deletes(target: DataFrame, delete_keys: DataFrame, key: str = "order_id") -> DataFrame:
    """X24 option of B8: remove deleted keys (anti join on the key; AQE
    broadcasts a small delete set)."""
    return target.join(delete_keys, key, "left_anti")


SCD_COLUMNS = ["scd_id", "valid_from", "valid_to", "snapshot_updated_at"]


def _scd_id(key_cols: Sequence[str], updated: str):
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols], F.col(updated).cast("string")))


def scd2_from_changelog(
    versions: DataFrame,
    key: str = "customer_id",
    updated_at: str = "customer_updated_at",
    bucket_seconds: int = 86400 * 30,
) -> DataFrame:
    """validity intervals from a full change log: ``valid_to`` is the
    next version's ``updated_at`` (NULL for the open version). The next
    version is found per (key, time bucket) with a carry from the next
    non-empty bucket, so a key with a huge history is split by time."""
    nxt = keyed_lag_lead(
        versions, [key], updated_at, [updated_at], direction="lead",
        bucket_seconds=bucket_seconds, prefix="_next_",
    )
    return nxt.select(
        *versions.columns,
        _scd_id([key], updated_at).alias("scd_id"),
        F.col(updated_at).alias("valid_from"),
        F.col(f"_next_{updated_at}").alias("valid_to"),
        F.col(updated_at).alias("snapshot_updated_at"),
    )


def scd2_apply(
    snapshot: DataFrame,
    source: DataFrame,
    run_ts: str,
    key: str = "customer_id",
    updated_at: str = "customer_updated_at",
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """One snapshot step, timestamp strategy.

    * key new in source -> insert an open version;
    * source ``updated_at`` later than the open version -> close it at the
      new ``updated_at`` and insert the new version;
    * open key missing from source -> closed at ``run_ts`` (hard delete).
    Closed history rows pass through untouched. One full outer join of the
    open rows with the source (shuffle by key) and a union."""
    attrs = [c for c in source.columns]
    closed = snapshot.where(F.col("valid_to").isNotNull())
    open_ = snapshot.where(F.col("valid_to").isNull())
    o = open_.select(*[F.col(c).alias(f"o_{c}") for c in open_.columns])
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
    j = o.join(s, F.col(f"o_{key}") == F.col(f"s_{key}"), "full_outer")
    s_upd, o_upd = F.col(f"s_{updated_at}"), F.col(f"o_{updated_at}")
    o_present, s_present = F.col(f"o_{key}").isNotNull(), F.col(f"s_{key}").isNotNull()
    changed = o_present & s_present & (s_upd > o_upd)
    deleted = o_present & ~s_present
    run = F.lit(run_ts).cast("timestamp")

    # open rows after this step: unchanged, closed by a change, closed by delete
    kept_open = j.where(o_present).select(
        *[F.col(f"o_{c}").alias(c) for c in attrs],
        F.col("o_scd_id").alias("scd_id"),
        F.col("o_valid_from").alias("valid_from"),
        F.when(changed, s_upd)
        .when(deleted & F.lit(invalidate_hard_deletes), run)
        .otherwise(F.lit(None).cast("timestamp"))
        .alias("valid_to"),
        F.col("o_snapshot_updated_at").alias("snapshot_updated_at"),
    )
    new_rows = j.where(s_present & (~o_present | changed)).select(
        *[F.col(f"s_{c}").alias(c) for c in attrs],
        _scd_id([f"s_{key}"], f"s_{updated_at}").alias("scd_id"),
        s_upd.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        s_upd.alias("snapshot_updated_at"),
    )
    cols = attrs + SCD_COLUMNS
    return closed.select(cols).unionByName(kept_open.select(cols)).unionByName(new_rows.select(cols))


def scd2_initial(source: DataFrame, key: str = "customer_id", updated_at: str = "customer_updated_at") -> DataFrame:
    """First snapshot: every source row is an open version."""
    return source.select(
        *source.columns,
        _scd_id([key], updated_at).alias("scd_id"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.col(updated_at).alias("snapshot_updated_at"),
    )


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    fact_ts: str,
    valid_from: str = "valid_from",
    valid_to: str | None = "valid_to",
    attributes: Sequence[str] = ("customer_tier",),
    suffix: str = "_at_event",
    bucket_seconds: int = 86400 * 30,
) -> DataFrame:
    """Attach the history version valid at each fact's time:
    key equal and ``valid_from <= ts < coalesce(valid_to, +inf)``.

    Not a range-conditioned equi-join (that pairs every fact of a key with
    every version of it before filtering: facts x versions for a hot key).
    The latest version with ``valid_from <= ts`` is found by a merge of facts
    and versions per (key, time bucket) (:func:`keyed_as_of`); it applies
    when the fact is before its ``valid_to``. With ``valid_to=None`` the
    history is a full change log (contiguous versions: each ends where the
    next starts), so the latest version at or before the fact is the answer
    and no validity intervals need computing first."""
    extra = [valid_to] if valid_to else []
    found = keyed_as_of(facts, history, [key], fact_ts, valid_from, [*attributes, *extra],
                        bucket_seconds=bucket_seconds, prefix="_asof_")
    ok = F.col(f"_asof_{valid_from}").isNotNull()
    if valid_to:
        ok = ok & (F.col(f"_asof_{valid_to}").isNull() | (F.col(fact_ts) < F.col(f"_asof_{valid_to}")))
    return found.select(
        *facts.columns,
        *[F.when(ok, F.col(f"_asof_{a}")).alias(f"{a}{suffix}") for a in attributes],
    )
