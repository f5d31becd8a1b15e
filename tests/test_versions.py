"""Versioned tables: a job stopped at any file-system call, readers, concurrent writers, the key index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.plans import pipelines
from ordermart.session import scratch_path
from ordermart.sinks import key_index, lake as sink, versions
from ordermart.sinks.versions import VersionedTable

#: The calls that change something: between two of them the folders look the same wherever a job stops.
CALLS = ("create_file", "delete_folder", "write_parquet")


class Stopped(Exception):
    pass


def stop_at(monkeypatch, number):
    """Make the ``number``-th file-system call fail: an even one before it does anything, an odd one
    after it is done (a created file is left empty). Returns the count of calls."""
    count = [0]
    for name in CALLS:
        real = getattr(versions, name)

        def call(*args, real=real, name=name):
            at, count[0] = count[0], count[0] + 1
            if at == number // 2:
                if number % 2:
                    real(*(args if name != "create_file" else (*args[:2], "")))
                raise Stopped(name)
            return real(*args)

        monkeypatch.setattr(versions, name, call)
    return count


def every_stop(monkeypatch, prepare, job, result):
    """Run ``job`` on a fresh ``prepare()``d state for each place to stop: readers see the state before or
    after, and a second run gives what an undisturbed one gives."""
    root = prepare()
    before = result(root)
    with monkeypatch.context() as m:
        calls = stop_at(m, -2)
        job(root)
    after = result(root)
    assert before != after
    for number in range(2 * calls[0]):
        root = prepare()
        with monkeypatch.context() as m:
            stop_at(m, number)
            with pytest.raises(Stopped):
                job(root)
        assert result(root) in (before, after), number
        job(root)
        assert result(root) == after, number


def customers(spark, *values):
    return spark.createDataFrame(list(values), "customer_id string, customer_tier string, updated string").select(
        "customer_id", "customer_tier", F.col("updated").cast("timestamp").alias("customer_updated_at"))


@pytest.fixture
def few_tasks(spark):
    from ordermart.session import sql_conf

    with sql_conf(spark, {"spark.sql.shuffle.partitions": "1"}):
        yield


def test_snapshot_stopped_anywhere_keeps_its_history(spark, monkeypatch, few_tasks):
    one = customers(spark, ("A", "gold", "2024-01-01"), ("B", "silver", "2024-01-01"), ("C", "gold", "2024-01-01")).cache()
    two = customers(spark, ("A", "platinum", "2024-02-01"), ("B", "silver", "2024-01-01"), ("D", "gold", "2024-02-02")).cache()

    def prepare():
        p = pipelines.LakePaths.under(scratch_path(spark, "stop"))
        pipelines.run_snapshot(spark, p, one, "2024-01-15 00:00:00")
        return p

    every_stop(monkeypatch, prepare, lambda p: pipelines.run_snapshot(spark, p, two, "2024-02-15 00:00:00"),
               lambda p: sorted(map(str, versions.read_table(spark, p.snapshots).drop("scd_part").collect())))


def orders(spark, *values):
    return spark.createDataFrame(list(values), "order_id string, order_status string, order_date string").withColumn(
        "order_date", F.to_date("order_date"))


def test_merge_stopped_anywhere_keeps_every_key_once(spark, monkeypatch, few_tasks):
    first = orders(spark, ("A", "pending", "2024-03-01"), ("B", "pending", "2024-03-01"), ("C", "pending", "2024-03-02")).cache()
    second = orders(spark, ("B", "moved", "2024-03-03"), ("C", "shipped", "2024-03-02")).cache()

    def prepare():
        root = scratch_path(spark, "stop")
        sink.merge_into_partitions(first, root, "order_id", "order_date")
        return root

    every_stop(monkeypatch, prepare, lambda root: sink.merge_into_partitions(second, root, "order_id", "order_date"),
               lambda root: sorted(map(str, versions.read_table(spark, root).collect())))


def test_latest_copy_stopped_anywhere_is_whole(spark, monkeypatch, few_tasks):
    def prepare():
        root = scratch_path(spark, "stop")
        sink.write_snapshot_and_latest(spark.range(3), f"{root}/gold", f"{root}/latest", "2024-03-01")
        return root

    def latest(root):
        return sorted(r[0] for r in versions.read_table(spark, f"{root}/latest").collect())

    every_stop(monkeypatch, prepare, lambda root: sink.write_snapshot_and_latest(
        spark.range(5), f"{root}/gold", f"{root}/latest", "2024-03-02"), latest)


def test_two_writers_from_one_version_cannot_both_commit(spark):
    table = VersionedTable(spark, scratch_path(spark, "two"))
    table.replace(spark.range(2))
    base = table.head()
    table.write(spark.range(3), None, base, None)
    with pytest.raises(RuntimeError):
        table.write(spark.range(4), None, base, None)
    assert table.read().count() == 3


def test_a_reader_keeps_its_version_and_old_ones_go(spark):
    table = VersionedTable(spark, scratch_path(spark, "read"))
    table.replace(spark.range(2))
    old = table.read()
    table.replace(table.read().union(spark.range(10, 11)))
    assert old.count() == 2 and table.read().count() == 3  # read after the commit
    for n in range(4):
        table.replace(spark.range(n))
    assert len(versions.list_folder(spark, f"{table.root}/data")) == len(versions.list_folder(spark, f"{table.root}/_log")) == versions.KEEP
    table.replace(spark.range(0))
    assert table.read().count() == 0 and table.read().columns == ["id"]


def test_filters_miss_no_key():
    rng = np.random.default_rng(3)
    for n in (1, 5, 1000, 50_000):
        keys = rng.integers(-2**63, 2**63 - 1, n)
        bits = key_index._filter(keys)
        assert len(bits) <= n * key_index.BITS / 4 + 8
        assert all(key_index._may_hold(bits, keys[i:i + 1]) for i in range(min(n, 500)))
        assert not key_index._may_hold(bits, rng.integers(-2**63, 2**63 - 1, 20_000))  # 3 in 10 million each
        assert not key_index._may_hold(bits, keys[:0])


def test_merge_reads_the_keys_of_candidate_dates_only(spark, monkeypatch):
    root = scratch_path(spark, "index")
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 21)]
    rows = [(f"K{i}-{d}", "pending", day) for d, day in enumerate(days) for i in range(30)]
    sink.merge_into_partitions(orders(spark, *rows), root, "order_id", "order_date")
    table = VersionedTable(spark, root)
    base = table.head()
    read = []
    real = VersionedTable.read

    def spy(self, parts=None, version=None):
        out = real(self, parts, version)
        read.append(sorted({f.split("order_date=")[1][:10] for f in out.inputFiles() if "order_date=" in f}))
        return out

    monkeypatch.setattr(VersionedTable, "read", spy)
    updates = orders(spark, ("K3-7", "shipped", days[7]), ("K5-12", "moved", "2024-05-01"), ("new", "pending", days[40]))
    touched = sink.merge_into_partitions(updates, root, "order_id", "order_date")
    assert [str(t) for t in touched] == sorted([days[7], days[12], days[40], "2024-05-01"])
    keys, whole = read
    assert set(keys) >= {days[7], days[12]} and len(keys) <= 4  # a wrong answer of a filter is one in millions
    assert whole == sorted([days[7], days[12], days[40]])
    monkeypatch.undo()
    got = {r.order_id: (r.order_status, str(r.order_date)) for r in table.read().collect()}
    assert len(got) == table.read().count() == 1801
    assert got["K5-12"] == ("moved", "2024-05-01") and got["K3-7"] == ("shipped", days[7])
    assert sum(base.parts.get(p) == t for p, t in table.head().parts.items()) == 57  # other dates: the same files
    # a second merge finds keys in the replaced dates as well
    assert [str(t) for t in sink.merge_into_partitions(orders(spark, ("K5-12", "back", days[12])), root, "order_id", "order_date")] == [
        days[12], "2024-05-01"]
    assert "2024-05-01" not in {str(r[0]) for r in table.read().select("order_date").distinct().collect()}


def test_large_updates_take_all_dates(spark):
    root = scratch_path(spark, "index")
    sink.merge_into_partitions(orders(spark, *((f"K{i}", "a", f"2024-01-{i + 1:02d}") for i in range(9))), root, "order_id", "order_date")
    table = VersionedTable(spark, root)
    keys = spark.createDataFrame([("K1",), ("K2",)], "order_id string")
    version = table.head()
    index = spark.read.schema(key_index.SCHEMA + ", version string").parquet(f"{root}/_keys")
    assert key_index.candidates(index, version.parts, keys, "order_id") == ["order_date=2024-01-02", "order_date=2024-01-03"]
    assert key_index.candidates(index, version.parts, keys, "order_id", max_keys=1) == list(version.parts)


def plan_of(df):
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_newest_value_from_metadata(spark):
    """From the log for a partition column, from file footers for others: no column is read."""
    from ordermart.sources import lake

    root = scratch_path(spark, "newest")
    sink.merge_into_partitions(orders(spark, ("A", "x", "2024-03-01"), ("B", "x", "2024-03-09")), root, "order_id", "order_date")
    assert str(lake.newest_value(spark, root, "order_date")) == "2024-03-09"
    plain = scratch_path(spark, "newest")
    spark.range(1000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d")).write.parquet(plain)
    assert lake.newest_value(spark, plain, "id") == 999 and str(lake.newest_value(spark, plain, "d")) == "2026-09-26"
    plan = plan_of(lake.newest_plan(spark, [plain], "d"))
    assert "PushedAggregation: [MAX(d)]" in plan
    assert "PushedAggregation: [MAX" not in plan_of(spark.read.parquet(plain).agg(F.max("d")))  # the settings are put back


def test_a_night_reads_ninety_days_of_folders(spark):
    from ordermart.streaming import scorer

    root = scratch_path(spark, "night")
    tx = spark.range(400).select(
        F.lit("A").alias("card_id"), F.concat(F.lit("T"), "id").alias("transaction_id"), F.lit("D").alias("device_fingerprint"),
        F.lit("web").alias("merchant_category"), F.lit(1).cast("decimal(18,4)").alias("amount_usd"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("event_date"))
    tx = tx.withColumn("event_time", F.date_format("event_date", "yyyy-MM-dd'T'12:00:00.000000'Z'"))
    tx.write.partitionBy("event_date").parquet(root)
    stored = spark.read.parquet(root)
    limited, whole = (scorer.profile_tables(stored, "2023-12-31", c) for c in ("event_date", None))
    for name in whole:
        assert sorted(map(str, limited[name].collect())) == sorted(map(str, whole[name].collect()))
        assert "PartitionFilters: [isnotnull(event_date" in plan_of(limited[name])
    limited["devices"].collect()
    scan = [m for m in plan_of(limited["devices"]).splitlines() if "PartitionFilters" in m]
    assert scan and "event_date" in scan[0]


def test_freshness_of_runs(spark):
    from ordermart.operators import quality

    runs = spark.createDataFrame([("bronze", "2024-01-01", 1704067200000), ("bronze", "2024-01-02", 1704100000000), ("silver", "x", None)],
                                 "layer string, run_date string, newest_ts_ms long")
    got = {r.layer: (r.age_hours, r.status) for r in quality.freshness_of_runs(runs, "2024-01-01 10:06:40").collect()}
    assert got == {"bronze": (1.0, "pass"), "silver": (None, "error")}
