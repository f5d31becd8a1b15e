"""Plan-level checks of the scale properties the operators promise."""

import re

import pytest

from ordermart.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, df):
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", ["silver_orders", "customer_ltv", "fct_orders_merged", "dim_customers",
                                  "revenue_summary", "tier_at_order_time", "dq_suite_results", "offline_features",
                                  "fraud_decisions", "nightly_profile", "scd2_apply_step"])
def test_no_pairwise_joins(spark, name):
    text = plan(spark, QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_aggregates_are_partial_before_the_shuffle(spark):
    text = plan(spark, QUERIES["customer_ltv"](spark, SF))
    # the latest version per key is limited to one row per key map-side, and the LTV aggregate is partial
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text
    assert "partial_count" in text and "partial_sum" in text


def test_card_windows_partition_by_key_and_time_bucket(spark):
    text = plan(spark, QUERIES["tx_velocity"](spark, SF))
    parts = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert any("card_id" in p and "_b" in p for p in parts)
    assert not any(p.strip().startswith("card_id") and "_b" not in p for p in parts)


def test_as_of_join_is_not_a_range_join(spark):
    text = plan(spark, QUERIES["tier_at_order_time"](spark, SF))
    assert "valid_to" not in re.sub(r"\s+", " ", " ".join(re.findall(r"Join condition: .*", text)))


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, QUERIES["ltv_totals"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<.*>)", text)
    assert schemas and all("o_orderpriority" not in s and "o_orderstatus" not in s for s in schemas)
