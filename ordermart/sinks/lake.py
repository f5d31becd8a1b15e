"""Parquet lake writers.

File sizes follow the data (B14): every write but Bronze's (one folder, straight from a scan) goes through a ``REBALANCE``
hint, by which AQE joins small pieces and splits large ones (a hot date, a
one-day load) toward the advisory size; no writer has a fixed number of tasks.
Partition writes use dynamic partition overwrite, so a rerun replaces only
the partitions it produces. Keyed tables are merged partition by partition and
whole tables are replaced as atomic versions (``versions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.operators.change import merge_upsert
from ordermart.operators.clean import VERSION_ORDER, latest_per_key
from ordermart.operators.quality import counted
from ordermart.schemas import RUN_METRICS
from ordermart.session import cut_lineage, delete_path, discard_cut, sql_conf
from ordermart.sinks.versions import MAX_RECORDS_PER_FILE, VersionedTable, part_name, replace_table


def _writer(df: DataFrame, mode: str = "overwrite"):
    return (
        df.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    )


def write_bronze(df: DataFrame, root: str, run_date: str) -> int:
    """B1: idempotent replace of one ingestion-date partition. Returns the rows written. All rows go to one
    folder and come out of a scan, which joins small files and splits large ones, so they are written where they are read, without a shuffle."""
    return _write_counted(df.withColumn("ingestion_date", F.lit(str(run_date))),
                          lambda out: _writer(out).partitionBy("ingestion_date").parquet(root))


def _write_counted(df: DataFrame, write) -> int:
    """Run ``write`` on the frame; its rows are counted in the tasks that write them."""
    out, seen = counted(df, rows=F.count(F.lit(1)))
    write(out)
    return seen.get["rows"]


def write_partitioned(df: DataFrame, root: str, partition_col: str) -> int:
    """Dynamic overwrite of every partition present in ``df``. Returns the rows written.

    AQE keeps splitting large partition values (REBALANCE skew handling) but
    does not coalesce for this write: coalescing by bytes would hand a
    many-date backfill of small dates to one task that opens every file in
    turn, while the uncoalesced hash spread writes them in parallel (empty
    shuffle partitions write nothing)."""
    with sql_conf(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        return _write_counted(df.hint("rebalance", partition_col),
                              lambda out: _writer(out).partitionBy(partition_col).parquet(root))


def merge_into_partitions(updates: DataFrame, root: str, key: str, partition_col: str,
                          order_by: Sequence[str] | None = None) -> list:
    """Merge rows by key into a versioned table partitioned by ``partition_col``.

    Touched partitions are those of the update rows and those where their
    keys now lie (a key whose date moves leaves its old date). The key index
    names the folders that may hold a key; only these are read for their keys, only the touched ones
    are read whole, merged and replaced, and one commit makes the new version
    current. The files of all other partitions stay as they are. With
    ``order_by`` the latest of old and new row per key stays, so an older run
    cannot overwrite newer rows; without it the update wins. The list of
    touched dates is what reaches the driver. Returns it."""
    table = VersionedTable(updates.sparkSession, root)
    base = table.head()
    if base is None:  # read once
        table.write(updates, partition_col, None, None, key=key)
        return []
    rows = updates.select(base.schema.fieldNames())
    updates = rows if getattr(updates, "_cut_path", None) else cut_lineage(rows)  # read several times
    there = table.read(table.holding(base, updates.select(key), key), base)
    where_now = there.select(key, partition_col).join(updates.select(key), key, "left_semi")
    touched = [r[0] for r in updates.select(partition_col).union(where_now.select(partition_col)).distinct().collect()]
    names = [part_name(partition_col, v) for v in touched]
    old = table.read(names, base)
    merged = cut_lineage(latest_per_key(old.unionByName(updates), key, order_by) if order_by
                         else merge_upsert(old, updates, key))
    table.write(merged, partition_col, base, names, key=key)
    discard_cut(updates, merged)
    return sorted(touched)


def delete_from_partitions(keys: DataFrame, root: str, key: str, partition_col: str) -> list:
    """Remove keys from a versioned partitioned table, rewriting only the dates that hold them."""
    table = VersionedTable(keys.sparkSession, root)
    base = table.head()
    there = table.read(table.holding(base, keys.select(key), key), base)
    touched = [r[0] for r in there.select(key, partition_col).join(keys.select(key), key, "left_semi")
               .select(partition_col).distinct().collect()]
    if touched:
        names = [part_name(partition_col, v) for v in touched]
        left = cut_lineage(table.read(names, base).join(keys.select(key), key, "left_anti"))
        table.write(left, partition_col, base, names, key=key)
        discard_cut(left)
    return sorted(touched)


def write_silver(df: DataFrame, root: str, key: str = "order_id", partition_col: str = "order_date") -> None:
    """B2 with X3 fixed: latest version per key across stored and new rows."""
    merge_into_partitions(df, root, key, partition_col, VERSION_ORDER)


def write_snapshot_and_latest(df: DataFrame, gold_root: str, latest_path: str, as_of: str) -> None:
    """The dated snapshot is written from ``df``; the stable latest copy is
    copied from that snapshot's files, so nothing is computed or cached twice. Both are versioned tables."""
    snapshots = VersionedTable(df.sparkSession, gold_root)
    dated = part_name("as_of_date", as_of)
    version = snapshots.write(df.withColumn("as_of_date", F.lit(as_of)), "as_of_date", snapshots.head(), [dated])
    replace_table(snapshots.read([dated], version).drop("as_of_date"), latest_path)


def quarantine_corrupt(corrupt: DataFrame, path: str, run_date: str, quarantined_at: str | None = None) -> int:
    """Unparsable lines as JSON with the quarantine time, in the folder of their run date; a
    rerun of a date replaces its lines, also by none. The raw
    line is stored as ``_raw_record`` (a plain column: Spark treats a field
    named ``_corrupt_record`` specially when the quarantine is read back).
    The reject set is small by nature; it is written as it is partitioned. Returns the rows written."""
    ts = F.current_timestamp() if quarantined_at is None else F.lit(quarantined_at).cast("timestamp")
    return _write_counted(corrupt.select(F.col("_corrupt_record").alias("_raw_record"), ts.alias("_quarantine_ts")),
                          lambda out: out.write.mode("overwrite").json(f"{path}/quarantine_date={run_date}"))


def write_rejects(rejects: DataFrame, path: str, run_date: str) -> int:
    """Events that a layer does not take, with their reason; a rerun of a date
    replaces its rejects, also by none. Returns the rows written."""
    return _write_counted(rejects, lambda out: out.write.mode("overwrite").parquet(f"{path}/reject_date={run_date}"))


def quarantine_invalid(invalid: DataFrame, path: str, run_date: str) -> int:
    """Rule violators with reason and date, by ingestion date; a rerun of a
    date replaces that date's rejects, also by none. Returns the rows written."""
    out = invalid.withColumn("_quarantine_date", F.lit(str(run_date)))
    if "_quarantine_reason" not in out.columns:
        out = out.withColumn("_quarantine_reason", F.lit("business_rule_violation"))
    delete_path(invalid.sparkSession, f"{path}/_ingestion_date={run_date}")
    return _write_counted(out, lambda o: _writer(o).partitionBy("_ingestion_date").parquet(path))


def write_run_metrics(spark, path: str, layer: str, run_date: str, values: dict) -> None:
    """The measures of one run of a layer; a rerun replaces them."""
    row = tuple(values.get(f.name) for f in RUN_METRICS.fields)
    spark.createDataFrame([row], RUN_METRICS).coalesce(1).write.mode("overwrite").parquet(f"{path}/layer={layer}/run_date={run_date}")


def write_profile_features(profile: DataFrame, path: str) -> None:
    """Per-card profile; lists as JSON text and every other feature as
    a string, with its expiry date (overwrite of the whole nightly table)."""
    cols = []
    for f in profile.schema.fields:
        if f.name in ("card_id", "expires_on"):
            cols.append(F.col(f.name))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    _writer(profile.select(*cols)).parquet(path)


def write_clustered(df: DataFrame, path: str, cluster_col: str = "order_date") -> None:
    """G1: rows of a cluster value lie together, sorted, so readers that filter
    on it skip whole row groups; a value too large for one task is split."""
    _writer(df.hint("rebalance", cluster_col).sortWithinPartitions(cluster_col)).parquet(path)


def write_audit(scored: DataFrame, path: str, date_col: str = "event_date") -> None:
    """Append every scored event, by event date."""
    scored.write.mode("append").option("compression", "snappy").partitionBy(date_col).parquet(path)


def analyze_table(spark, table: str) -> None:
    """Statistics for the optimizer after a build."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def save_table(df: DataFrame, database: str, table: str, location: str, cluster_col: str | None = None) -> str:
    """Write ``df`` as a catalog table of ``database`` (created at
    ``location`` when missing) and compute its statistics, so later joins on
    it are planned from real sizes. Returns the qualified name."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    name = f"{database}.{table}"
    out = df.hint("rebalance", cluster_col).sortWithinPartitions(cluster_col) if cluster_col else df
    out.write.mode("overwrite").format("parquet").saveAsTable(name)
    analyze_table(spark, name)
    return name


def table_statistics(spark, table: str) -> DataFrame:
    """Row count and size the catalog holds for ``table`` (after ANALYZE)."""
    from pyspark.sql import functions as F

    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Statistics")
    return stats.select(
        F.lit(table).alias("table_name"),
        F.regexp_extract("data_type", r"([0-9]+) rows", 1).cast("bigint").alias("row_count"),
    )
