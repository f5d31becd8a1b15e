"""Session factory and shared-folder helpers.

``get_spark`` builds one session for jobs and tests. Cluster settings keep AQE,
partition coalescing and skew-join splitting on; local settings shrink the
shuffle width. Scratch output (lineage cuts, round-trip tables) always goes
under the folder the cluster names in ``spark.checkpoint.dir``; a folder of our
own is only chosen when that setting is unset, as in tests.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLUSTER_SHUFFLE_PARTITIONS = 400
LOCAL_SHUFFLE_PARTITIONS = 8


def get_spark(
    app_name: str = "ordermart",
    local: bool = False,
    extra_conf: dict | None = None,
    cores: int | str = "*",
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if local:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(LOCAL_SHUFFLE_PARTITIONS))
            .config("spark.driver.memory", "8g")
        )
    else:
        # AQE coalesces and REBALANCE sizes files toward the advisory size:
        # ~200 MB snappy files, the layer's target, from 256 MB of shuffle data
        builder = (
            builder.config("spark.sql.shuffle.partitions", str(CLUSTER_SHUFFLE_PARTITIONS))
            .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
            # use the advisory size as the coalescing target (the default
            # parallelism-first mode would only merge up to 1 MB)
            .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
            .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "4")
            # keyed stream state (per card) off-heap in RocksDB, checkpointed as changelogs
            .config("spark.sql.streaming.stateStore.providerClass",
                    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
            .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        )
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a shared folder (object store / HDFS) that "
                "all executors and the driver can reach; a machine-local folder would not survive executor loss")
        conf_dir = tempfile.mkdtemp(prefix="ordermart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "ordermart", f"{name}-{uuid.uuid4().hex[:12]}"])


def prepare_session(spark: SparkSession) -> None:
    """Settings the registered queries rely on, applied to any caller's
    session: UTC session clock (timestamps are parsed and formatted as UTC)
    and a checkpoint folder (kept when the cluster names one)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def cut_lineage(df: DataFrame, how: str = "table") -> DataFrame:
    """Cut the lineage through the shared checkpoint folder (survives
    executor loss). ``how="table"`` (default) writes a Parquet table there
    and reads it back, so later steps still get column pruning and filter
    pushdown; ``how="checkpoint"`` is Spark's reliable RDD checkpoint."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "cut")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._cut_path = path
    return out


def discard_cut(*frames: DataFrame) -> None:
    """Delete the tables behind lineage cuts once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            delete_path(df.sparkSession, path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a table folder, whatever store it is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """Within, each job's shuffle files are deleted when the job ends; they would stay until the driver
    collects its garbage, which on a large input is after many jobs."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Temporarily set the shuffle width, e.g. while a stateful stream starts:
    its state-store partition count is fixed by the first run's setting and
    stays for the life of the checkpoint, so it is chosen deliberately
    (default: the cluster's parallelism) rather than inherited."""
    if n is None:
        n = spark.sparkContext.defaultParallelism
    with sql_conf(spark, {"spark.sql.shuffle.partitions": str(n)}):
        yield n


@contextlib.contextmanager
def stream_start(spark: SparkSession, state_partitions: int | None):
    """Settings a keyed stream captures when it starts: its state width, state in RocksDB (which the
    id memory needs), and no batches without data (a processing-time timeout would otherwise ask for one
    after the other; timeouts are handled with the next data)."""
    with shuffle_partitions(spark, state_partitions) as n, sql_conf(spark, {
            "spark.sql.streaming.noDataMicroBatches.enabled": "false",
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}):
        yield n


@contextlib.contextmanager
def sql_conf(spark: SparkSession, settings: dict):
    """Temporarily apply SQL settings (restored afterwards)."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
