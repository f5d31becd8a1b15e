"""Keyed time windows that split hot keys by time.

``Window.partitionBy(card)`` sends all rows of one card to one task; when one
card holds a third of all rows that task holds a third of the data. The
helpers here partition by (key, time bucket) instead and stay exact:

* :func:`trailing_stats` - sum and count of earlier rows of the same key in
  ``[t - frame, t)``. With unit ``U`` and ``frame = k * U`` the frame is the
  earlier part of the row's own bucket, the ``k - 1`` full buckets before it
  (from a per-(key, bucket) pre-aggregate, rolled over buckets) and the later
  part of bucket ``b - k``, whose rows are replicated into bucket ``b`` as
  context rows shifted by ``frame``. Each row is stored at most twice.
* :func:`keyed_lag_lead` - previous / next row of the same key by (time, tie):
  within the bucket by a window, across buckets from a one-row-per-bucket
  table rolled over the key's non-empty buckets.
* :func:`keyed_as_of` - the version of another table in force at each row's
  time (as-of join) the same way, without pairing rows with versions.
* :func:`keyed_prev_time` - the latest strictly earlier time of the key
  ("seen within N days" without replicating rows).

The per-key windows that remain run over one row per non-empty bucket only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def trailing_stats(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    frame_seconds: int,
    unit_seconds: int | None = None,
    values: Mapping[str, Column] | None = None,
    prefix: str = "w_",
    lag_cols: Sequence[str] = (),
    tie: str | None = None,
    lag_prefix: str = "prev_",
) -> DataFrame:
    """Add ``{prefix}count`` and ``{prefix}sum_<name>`` over the earlier rows
    of the same key with time in ``[t - frame, t)`` (rows at the same instant
    are not earlier). ``frame_seconds`` must be a multiple of ``unit_seconds``
    (default: one unit = the frame).

    With ``lag_cols`` the same pass also adds ``{lag_prefix}<col>`` of the
    previous row of the key by (time, ``tie``): the latest earlier own row of
    the bucket (a ROWS frame over the same partitioning, no extra shuffle),
    else the last row of the previous non-empty bucket from the per-bucket
    aggregate that the full-bucket sums already use."""
    unit = unit_seconds or frame_seconds
    if frame_seconds % unit:
        raise ValueError("frame_seconds must be a multiple of unit_seconds")
    k = frame_seconds // unit
    frame_us = frame_seconds * MICROS
    unit_us = unit * MICROS
    values = dict(values or {})
    keys = list(keys)

    base = df.withColumn("_t", _micros(ts)).withColumn("_b", F.floor(F.col("_t") / F.lit(unit_us)).cast("bigint"))
    for name, expr in values.items():
        base = base.withColumn(f"_v_{name}", expr)
    vcols = [f"_v_{n}" for n in values]
    own = base.withColumn("_ctx", F.lit(False))
    other = [c for c in own.columns if c not in keys + ["_t", "_b", "_ctx"] + vcols]
    ctx = base.select(
        *keys,
        (F.col("_t") + F.lit(frame_us)).alias("_t"),
        (F.col("_b") + F.lit(k)).alias("_b"),
        *vcols,
        *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in other],
        F.lit(True).alias("_ctx"),
    ).select(own.columns)
    u = own.unionByName(ctx)

    w = Window.partitionBy(*keys, "_b").orderBy("_t")
    before = w.rangeBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys, "_b")
    is_own, is_ctx = ~F.col("_ctx"), F.col("_ctx")
    # context rows from now on = all of the bucket's minus those before: running
    # sums and one total, so work is linear in the rows of a bucket
    from_now = lambda fn: (F.coalesce(fn.over(whole), F.lit(0)) - F.coalesce(fn.over(before), F.lit(0)))
    stats = {
        "_cnt_own": F.count(F.when(is_own, F.lit(1))).over(before),
        "_cnt_ctx": from_now(F.count(F.when(is_ctx, F.lit(1)))),
    }
    for v in vcols:
        stats[f"_s_own{v}"] = F.sum(F.when(is_own, F.col(v))).over(before)
        stats[f"_s_ctx{v}"] = from_now(F.sum(F.when(is_ctx, F.col(v))))
    lag_cols = list(lag_cols)
    if lag_cols:
        payload = F.struct(F.col("_t").alias("_pt"), *([F.col(tie).alias("_ptie")] if tie else []),
                           *[F.col(c).alias(c) for c in lag_cols])
        u = u.withColumn("_payload", F.when(is_own, payload))
        order = ["_t"] + ([tie] if tie else [])
        earlier = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        stats["_prev_in"] = F.max("_payload").over(earlier)
    scored = u.select("*", *[e.alias(n) for n, e in stats.items()]).where(~F.col("_ctx"))

    count = F.col("_cnt_own") + F.col("_cnt_ctx")
    sums = {v: F.coalesce(F.col(f"_s_own{v}"), F.lit(0)) + F.coalesce(F.col(f"_s_ctx{v}"), F.lit(0)) for v in vcols}
    prev = F.col("_prev_in") if lag_cols else None
    if k > 1 or lag_cols:
        aggs = [F.count(F.lit(1)).alias("_bc"), *[F.sum(v).alias(f"_bs{v}") for v in vcols]]
        if lag_cols:
            aggs.append(F.max(payload).alias("_edge"))
        per_bucket = base.groupBy(*keys, "_b").agg(*aggs)
        by_bucket = Window.partitionBy(*keys).orderBy("_b")
        roll = by_bucket.rangeBetween(-(k - 1), -1) if k > 1 else None
        sel = [*keys, "_b"]
        if k > 1:
            sel += [F.coalesce(F.sum("_bc").over(roll), F.lit(0)).alias("_full_c"),
                    *[F.sum(f"_bs{v}").over(roll).alias(f"_full_s{v}") for v in vcols]]
        if lag_cols:
            sel.append(F.lag("_edge").over(by_bucket).alias("_carry"))
        scored = scored.join(per_bucket.select(*sel), keys + ["_b"], "left")
        if k > 1:
            count = count + F.coalesce(F.col("_full_c"), F.lit(0))
            sums = {v: s + F.coalesce(F.col(f"_full_s{v}"), F.lit(0)) for v, s in sums.items()}
        if lag_cols:
            prev = F.coalesce(F.col("_prev_in"), F.col("_carry"))

    out = scored.withColumn(f"{prefix}count", count.cast("bigint"))
    for name, v in zip(values, vcols):
        out = out.withColumn(f"{prefix}sum_{name}", sums[v])
    lag_out = [prev.getField(c).alias(f"{lag_prefix}{c}") for c in lag_cols]
    return out.select(*df.columns, f"{prefix}count", *[f"{prefix}sum_{n}" for n in values], *lag_out)


def trailing_counts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    frames: Mapping[str, int],
    unit_seconds: int | None = None,
) -> DataFrame:
    """Several short frames in one pass: for each ``name -> seconds`` add the
    count of earlier rows of the key in ``[t - seconds, t)``. Every frame must
    fit in one unit (default: an hour, or the longest frame).

    A row enters every frame at its time and leaves a frame ``seconds`` later,
    so a frame's count is the running sum of +1 and -1 marks before ``t``:
    linear in the rows of a (key, bucket), however many fall in a frame. A leave
    mark lies in the row's bucket or the next one, where an enter mark before
    the bucket's start goes with it. One shuffle and one running window for
    all frames."""
    unit = unit_seconds or max(3600, *frames.values())
    if any(f > unit for f in frames.values()):
        raise ValueError("every frame must fit in one unit")
    unit_us = unit * MICROS
    keys = list(keys)
    marks = [f"_m_{n}" for n in frames]
    base = df.withColumn("_t", _micros(ts)).withColumn("_b", F.floor(F.col("_t") / F.lit(unit_us)).cast("bigint"))
    own = base.select("*", *[F.lit(1).alias(m) for m in marks], F.lit(True).alias("_own"))
    start_next = (F.col("_b") + 1) * F.lit(unit_us)
    crosses = [F.col("_t") + F.lit(f * MICROS) >= start_next for f in frames.values()]
    entered = F.struct((start_next - 1).alias("_t"), (F.col("_b") + 1).alias("_b"),
                       *[F.when(c, 1).otherwise(0).alias(m) for c, m in zip(crosses, marks)])
    leaves = [F.struct((F.col("_t") + F.lit(f * MICROS)).alias("_t"), F.when(c, F.col("_b") + 1).otherwise(F.col("_b")).alias("_b"),
                       *[F.lit(-1 if m == own_mark else 0).alias(m) for m in marks])
              for f, c, own_mark in zip(frames.values(), crosses, marks)]
    others = base.select(*keys, F.explode(F.array(entered, *leaves)).alias("x")).select(*keys, "x.*")
    others = others.where(" or ".join(f"`{m}` <> 0" for m in marks))
    blank = [c for c in own.columns if c not in [*keys, "_t", "_b", "_own", *marks]]
    ctx = others.select("*", *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in blank],
                        F.lit(False).alias("_own")).select(own.columns)
    earlier = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    counts = [F.coalesce(F.sum(m).over(earlier), F.lit(0)).cast("bigint").alias(n) for n, m in zip(frames, marks)]
    out = own.unionByName(ctx).select("*", *counts).where("_own")
    return out.select(*df.columns, *frames)


def keyed_lag_lead(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value_cols: Sequence[str],
    direction: str = "lag",
    tie: str | None = None,
    bucket_seconds: int = 86400,
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``{prefix}<col>`` for the previous (``lag``) or next (``lead``) row
    of the same key ordered by (ts, tie)."""
    keys = list(keys)
    order = [ts] + ([tie] if tie else [])
    bucket_us = bucket_seconds * MICROS
    base = df.withColumn("_b", F.floor(_micros(ts) / F.lit(bucket_us)).cast("bigint"))
    payload = F.struct(*[F.col(c).alias(c) for c in value_cols])
    okey = F.struct(*[F.col(c) for c in order])
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    fn = F.lag if direction == "lag" else F.lead
    inner = base.withColumn("_in", fn(payload).over(w))
    if direction == "lag":
        edge = base.groupBy(*keys, "_b").agg(F.max_by(payload, okey).alias("_edge"))
        carry = Window.partitionBy(*keys).orderBy("_b")
        edges = edge.select(*keys, "_b", F.lag("_edge").over(carry).alias("_carry"))
    else:
        edge = base.groupBy(*keys, "_b").agg(F.min_by(payload, okey).alias("_edge"))
        carry = Window.partitionBy(*keys).orderBy("_b")
        edges = edge.select(*keys, "_b", F.lead("_edge").over(carry).alias("_carry"))
    joined = inner.join(edges, keys + ["_b"], "left")
    picked = F.coalesce(F.col("_in"), F.col("_carry"))
    return joined.select(*df.columns, *[picked.getField(c).alias(f"{prefix}{c}") for c in value_cols])


def keyed_as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    fact_ts: str,
    valid_from: str,
    payload_cols: Sequence[str],
    bucket_seconds: int = 86400 * 30,
    prefix: str = "asof_",
) -> DataFrame:
    """Latest history row of the same key with ``valid_from <= fact_ts``,
    for every fact, without pairing facts with versions.

    Facts and history rows are unioned and ordered by time within
    (key, time bucket), history first at equal times; the running max of the
    history payload (a struct led by ``valid_from``) is the latest version so
    far. The version in force at a bucket's start comes from a one-row-per-
    (key, bucket) table rolled over the key's buckets. Work per fact is
    constant however many versions or facts one key has."""
    keys = list(keys)
    bucket_us = bucket_seconds * MICROS
    h = history.select(
        *keys, F.col(valid_from).alias("_t"),
        F.struct(F.col(valid_from).alias("_vf"), *[F.col(c).alias(c) for c in payload_cols]).alias("_h"),
    )
    f_cols = facts.columns
    fr = facts.select(*[F.col(c) for c in f_cols], F.col(fact_ts).alias("_t"))
    hr = h.select(*[F.lit(None).cast(facts.schema[c].dataType).alias(c) if c not in keys else F.col(c) for c in f_cols],
                  "_t", "_h")
    u = fr.withColumn("_h", F.lit(None).cast(h.schema["_h"].dataType)).withColumn("_kind", F.lit(1)).unionByName(
        hr.withColumn("_kind", F.lit(0)))
    u = u.withColumn("_b", F.floor(_micros("_t") / F.lit(bucket_us)).cast("bigint"))
    w = Window.partitionBy(*keys, "_b").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    inner = u.withColumn("_in", F.max("_h").over(w)).where(F.col("_kind") == 1)
    buckets = u.groupBy(*keys, "_b").agg(F.max("_h").alias("_last"))
    carry_w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.select(*keys, "_b", F.max("_last").over(carry_w).alias("_carry"))
    j = inner.join(carry, keys + ["_b"], "left")
    picked = F.coalesce(F.col("_in"), F.col("_carry"))
    return j.select(*f_cols, *[picked.getField(c).alias(f"{prefix}{c}") for c in payload_cols],
                    picked.getField("_vf").alias(f"{prefix}{valid_from}"))


def keyed_prev_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    out: str = "prev_ts",
    bucket_seconds: int = 86400,
) -> DataFrame:
    """Add ``out``: the latest time of an earlier row of the same key
    (strictly earlier, microsecond epoch; NULL when none). "Seen within N
    days" is ``out >= t - N days``, which needs no row replication: a running
    max within (key, time bucket) plus, for a bucket's first rows, the max of
    the key's previous non-empty buckets."""
    keys = list(keys)
    bucket_us = bucket_seconds * MICROS
    base = df.withColumn("_t", _micros(ts)).withColumn("_b", F.floor(F.col("_t") / F.lit(bucket_us)).cast("bigint"))
    earlier = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    inner = base.withColumn("_pin", F.max("_t").over(earlier))
    per_bucket = base.groupBy(*keys, "_b").agg(F.max("_t").alias("_bmax"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*keys, "_b", F.max("_bmax").over(before).alias("_carry"))
    j = inner.join(carry, keys + ["_b"], "left")
    return j.select(*df.columns, F.coalesce(F.col("_pin"), F.col("_carry")).alias(out), "_t")
