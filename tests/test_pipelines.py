"""O1-O5 through Parquet folders: correct, and idempotent on rerun."""

from pyspark.sql import functions as F

from ordermart.plans import pipelines
from ordermart.plans.queries import AS_OF_TS, LTV_AS_OF, RUN_DATE
from ordermart.session import scratch_path
from ordermart.sources import adapters as A, lake

SF = "/root/testdata/sf0.001"


def test_layers_rerun_idempotent(spark):
    p = pipelines.LakePaths.under(scratch_path(spark, "pipe-test"))
    A.cdc_json_lines(A.load_table(spark, SF, "orders")).write.text(p.landing)
    n1 = pipelines.run_bronze(spark, p, RUN_DATE, AS_OF_TS)
    pipelines.run_silver(spark, p, RUN_DATE)
    g1 = sorted(pipelines.run_gold(spark, p, LTV_AS_OF).collect())
    s1 = sorted(lake.read_history(spark, p.silver).collect())
    # rerun every layer on the same landing
    n2 = pipelines.run_bronze(spark, p, RUN_DATE, AS_OF_TS)
    pipelines.run_silver(spark, p, RUN_DATE)
    g2 = sorted(pipelines.run_gold(spark, p, LTV_AS_OF).collect())
    s2 = sorted(lake.read_history(spark, p.silver).collect())
    assert n1 == n2 > 0
    assert spark.read.parquet(p.bronze).count() == n1          # partition replaced, not appended
    assert s1 == s2 and len(s1) == lake.read_history(spark, p.silver).select("order_id").distinct().count()
    assert g1 == g2 and len(g1) > 0
    corrupt = spark.read.json(p.quarantine)
    assert corrupt.where(F.col("_raw_record").isNotNull()).count() > 0


def test_marts_and_snapshot(spark):
    p = pipelines.LakePaths.under(scratch_path(spark, "marts-test"))
    A.cdc_json_lines(A.load_table(spark, SF, "orders")).write.text(p.landing)
    pipelines.run_bronze(spark, p, RUN_DATE, AS_OF_TS)
    pipelines.run_silver(spark, p, RUN_DATE)
    pipelines.run_gold(spark, p, LTV_AS_OF)
    cust = A.customers_src(A.load_table(spark, SF, "customer"))
    paths = pipelines.run_marts(spark, p, cust, LTV_AS_OF, AS_OF_TS)
    first = sorted(lake.read_history(spark, paths["fct_orders"]).collect())
    paths = pipelines.run_marts(spark, p, cust, LTV_AS_OF, AS_OF_TS)   # incremental merge run
    assert sorted(lake.read_history(spark, paths["fct_orders"]).collect()) == first
    dim = lake.read_history(spark, paths["dim_customers"])
    assert dim.count() == cust.count()
    snap = pipelines.run_snapshot(spark, p, cust.select(
        "customer_id", "customer_tier", F.col("updated_at").cast("timestamp").alias("customer_updated_at")), AS_OF_TS)
    assert snap.where("valid_to IS NULL").count() == cust.count()


def test_read_partition_prunes(spark):
    from ordermart.sinks import lake as sink

    root = scratch_path(spark, "prune")
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "order_id string, d string")
    sink.write_partitioned(df, root, "d")
    one = lake.read_partition(spark, root, "2024-01-02", "d")
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(d" in plan and "= 2024-01-02" in plan
    assert [r["order_id"] for r in one.collect()] == ["b"] and "d" in one.columns


def test_bronze_rerun_and_failed_gate(spark):
    """A rerun replaces corrupt lines and rejects, also by none; a run that fails its gate keeps Bronze as it was."""
    import pytest

    p = pipelines.LakePaths.under(scratch_path(spark, "rerun"))
    lines = A.cdc_json_lines(A.load_table(spark, SF, "orders")).cache()
    lines.write.text(f"{p.landing}/a")
    lines.where(F.col("value").startswith('{"op":"c"') & F.col("value").endswith("}}")).limit(40).write.text(f"{p.landing}/b")
    n = pipelines.run_bronze(spark, p, RUN_DATE, AS_OF_TS, source=f"{p.landing}/a")
    first = pipelines.bronze_written(spark, p, RUN_DATE, f"{p.landing}/a").first()
    assert first.balanced and first.kept_rows == n and min(first.corrupt_rows, first.deleted_rows, first.unknown_op_rows) > 0
    assert pipelines.run_bronze(spark, p, RUN_DATE, AS_OF_TS, source=f"{p.landing}/b") == 40  # the same date again, nothing rejected
    again = pipelines.bronze_written(spark, p, RUN_DATE, f"{p.landing}/b").first()
    assert tuple(again) == (40, 0, 40, 0, 0, True)
    pipelines.run_silver(spark, p, RUN_DATE, deletes=True)
    with pytest.raises(ValueError, match="volume_anomaly"):
        pipelines.run_bronze(spark, p, "2001-08-03", AS_OF_TS, source=f"{p.landing}/a")
    assert {str(r[0]) for r in spark.read.parquet(p.bronze).select("ingestion_date").distinct().collect()} == {RUN_DATE}
    kept = {r.run_date: (r.kept_rows, r.passed) for r in pipelines.run_metrics(spark, p).collect()}
    assert kept == {RUN_DATE: (40, True), "2001-08-03": (n, False)}


def test_first_version_and_bronze_are_written_as_they_are_read(spark, monkeypatch):
    """The first version of a keyed table needs no copy of its rows; Bronze goes to its one folder without a shuffle."""
    from pyspark.sql import functions as F

    from ordermart.session import scratch_path
    from ordermart.sinks import lake as sink
    from ordermart.sinks.versions import VersionedTable

    def never(*_):
        raise AssertionError("cut")

    root = scratch_path(spark, "keyed")
    rows = spark.range(40).select(F.col("id").cast("string").alias("order_id"), F.expr("date'2024-01-01' + int(id % 3)").alias("order_date"))
    with monkeypatch.context() as m:
        m.setattr(sink, "cut_lineage", never)
        assert sink.merge_into_partitions(rows, root, "order_id", "order_date") == []
    table = VersionedTable(spark, root)
    assert table.read().count() == 40
    wanted = spark.createDataFrame([("4",)], "order_id string")
    assert "order_date=2024-01-02" in table.holding(table.head(), wanted, "order_id")
    path = scratch_path(spark, "bronze")
    assert sink.write_bronze(spark.range(0, 40, 1, 4).select("id"), path, "2024-01-01") == 40
    assert sink.write_bronze(spark.range(0, 20, 1, 4).select("id"), path, "2024-01-01") == 20  # replaced
    back = spark.read.parquet(path)
    assert back.count() == 20 and back.select(F.input_file_name()).distinct().count() == 4
