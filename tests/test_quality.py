from decimal import Decimal

import pytest

from ordermart.operators import quality


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("a", "x", Decimal("1")), ("b", None, Decimal("-2")), ("b", "zz", None)],
                                 "id string, s string, amt decimal(10,2)")


def results(suite):
    return {r["check_name"]: (r["passed"], r["details"]) for r in suite.results().collect()}


def test_checks_pass_and_fail(df):
    s = (quality.QualitySuite(df, "t").not_empty().no_nulls(["id", "s"]).null_rate("s", 0.5).null_rate("amt", 0.2)
         .unique(["id"]).accepted_values("s", ["x", "y"]).expression_is_true("amt_pos", "amt >= 0")
         .volume(4, 0.30))
    r = results(s)
    assert r["not_empty"] == (True, "row_count=3")
    assert r["no_nulls:id"] == (True, "null_count=0")
    assert r["no_nulls:s"] == (False, "null_count=1")
    assert r["null_rate:s"] == (True, "null_rate=0.3333 threshold=0.5")
    assert r["null_rate:amt"][0] is False
    assert r["unique:id"] == (False, "total=3 distinct=2 dupes=1")
    assert r["accepted_values:s"] == (False, "distinct_invalid_values=1 invalid_rows=1")  # NULL passes
    assert r["expression_is_true:amt_pos"] == (False, "failing_rows=1")              # NULL amount passes
    assert r["volume_anomaly"][0] is True  # |3-4|/4 = 25% within 30%
    assert results(quality.QualitySuite(df, "t").volume(5, 0.30))["volume_anomaly"][0] is False  # 40%


def test_volume_tolerance_edge(spark):
    df = spark.range(7)
    r = results(quality.QualitySuite(df, "t").volume(10, 0.30))
    assert r["volume_anomaly"] == (True, "actual=7 expected=10 deviation=30.00%")


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string")
    r = results(quality.QualitySuite(df, "t").not_empty().null_rate("id", 0.0).unique(["id"]))
    assert r["not_empty"] == (False, "row_count=0")
    assert r["null_rate:id"] == (True, "null_rate=0.0000 threshold=0.0")
    assert r["unique:id"][0] is True


def test_validate_raises_with_names(df):
    with pytest.raises(ValueError, match="no_nulls:s"):
        quality.QualitySuite(df, "t").no_nulls(["s"]).validate()


def test_relationships_and_gate(spark, df):
    parent = spark.createDataFrame([("a",)], "id string")
    r = results(quality.QualitySuite(df, "t").relationships("id", parent, "id"))
    assert r["relationships:id"] == (False, "orphan_rows=2 orphan_keys=1")
    ok = spark.createDataFrame([("a",)], "id string")
    assert quality.gate(ok, quality.QualitySuite(ok, "t").not_empty()).count() == 1


def test_freshness(spark):
    from datetime import datetime

    df = spark.createDataFrame([(datetime(2024, 1, 1, 3, 0),)], "_ingested_at timestamp")
    for as_of, status in [("2024-01-01 04:00:00", "pass"), ("2024-01-01 06:00:00", "warn"), ("2024-01-01 10:00:00", "error")]:
        assert quality.source_freshness(df, "s", "_ingested_at", as_of).first()["status"] == status


def test_schema_conformance(spark, df):
    from pyspark.sql.types import _parse_datatype_string

    out = {r["column_name"]: r["passed"] for r in quality.schema_conformance(
        df, _parse_datatype_string("id string, s int, extra date")).collect()}
    assert out == {"id": True, "s": False, "extra": False, "amt": False}


def test_validate_counts_bad_values_without_gathering_them(spark):
    df = spark.range(3000).selectExpr("concat('free text ', id % 1000) s", "'x' t")
    s = quality.QualitySuite(df, "t").accepted_values("s", ["free text 1"]).accepted_values("t", ["x"])
    r = {x["check_name"]: (x["passed"], x["details"]) for x in s.validate(raise_on_failure=False)}
    assert r == {"accepted_values:s": (False, "distinct_invalid_values=999 invalid_rows=2997"),
                 "accepted_values:t": (True, "distinct_invalid_values=0 invalid_rows=0")}
    assert "collect_list" not in s.results()._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError, match="accepted_values:s"):
        s.validate()


def test_results_list_every_bad_value(spark):
    df = spark.createDataFrame([(f"bad {n:02d}", "x") for n in range(30)] * 2 + [("ok", "x"), (None, "x")], "s string, t string")
    s = quality.QualitySuite(df, "t").accepted_values("s", ["ok"]).accepted_values("t", ["x"])
    r = {x["check_name"]: (x["passed"], x["details"]) for x in s.results(list_values=True).collect()}
    listed = ", ".join(f"'bad {n:02d}'" for n in range(30))
    assert r == {"accepted_values:s": (False, f"invalid_values=[{listed}] invalid_rows=60"),
                 "accepted_values:t": (True, "invalid_values=[] invalid_rows=0")}
