from datetime import date
from decimal import Decimal

import pytest

from ordermart.operators import gold, marts

SILVER = "customer_id string, order_id string, order_status string, order_date date, order_total_usd decimal(18,4)"


def ltv(spark, rows, as_of="2024-06-30", **kw):
    return {r["customer_id"]: r for r in gold.compute_ltv_metrics(spark.createDataFrame(rows, SILVER), as_of, **kw).collect()}


def orders(cust, n, status, day, amount):
    return [(cust, f"{cust}-{status}-{i}-{day}", status, day, Decimal(amount)) for i in range(n)]


def test_one_customer_per_segment(spark):
    rows = (orders("champ", 2, "delivered", date(2024, 6, 20), "600")
            + orders("loyal", 4, "shipped", date(2024, 3, 1), "80")
            + orders("risk", 1, "delivered", date(2023, 1, 1), "700")
            + orders("new", 1, "pending", date(2024, 5, 1), "10")
            + orders("low", 1, "delivered", date(2023, 11, 1), "20"))
    got = ltv(spark, rows)
    assert {k: v["ltv_segment"] for k, v in got.items()} == {
        "champ": "champions", "loyal": "loyal", "risk": "at_risk", "new": "new_customers", "low": "low_value"}
    assert got["champ"]["total_revenue_usd"] == Decimal("1200.00")
    assert got["loyal"]["avg_order_value_usd"] == Decimal("80.00")
    assert got["new"]["completed_orders"] == 0 and got["new"]["avg_order_value_usd"] == Decimal("0.00")


def test_thresholds(spark):
    rows = (orders("c30", 1, "delivered", date(2024, 5, 31), "1000")            # recency exactly 30
            + orders("c31", 1, "delivered", date(2024, 5, 30), "1000")          # 31 -> not champion
            + orders("cancel", 9, "delivered", date(2024, 6, 29), "200") + orders("cancel", 1, "cancelled", date(2024, 6, 29), "1"))
    got = ltv(spark, rows)
    assert got["c30"]["ltv_segment"] == "champions"
    assert got["c31"]["ltv_segment"] == "new_customers"
    assert got["cancel"]["cancel_rate"] == 0.1 and got["cancel"]["ltv_segment"] == "loyal"


def test_leap_day_cutoff(spark):
    rows = orders("a", 1, "delivered", date(2023, 2, 28), "10") + orders("a", 1, "delivered", date(2023, 2, 27), "10")
    got = ltv(spark, rows, as_of="2024-02-29")
    assert got["a"]["orders_l12m"] == 1


def test_fused_equals_join_variant(spark):
    from ordermart.plans.queries import silver

    s = silver(spark, "/root/testdata/sf0.001")
    a = sorted(gold.compute_ltv_metrics(s, "2001-08-01").collect())
    b = sorted(gold.ltv_metrics_by_class(s, "2001-08-01").collect())
    assert a == b


@pytest.mark.parametrize("usd,band", [(None, "enterprise"), ("24.99", "micro"), ("25", "small"), ("99.99", "small"),
                                      ("100", "medium"), ("500", "large"), ("1999.99", "large"), ("2000", "enterprise")])
def test_revenue_band_edges(spark, usd, band):
    from pyspark.sql import functions as F

    from ordermart.functions.columns import revenue_band

    df = spark.createDataFrame([(None if usd is None else Decimal(usd),)], "x decimal(18,2)")
    assert df.select(revenue_band(F.col("x")).alias("b")).first()["b"] == band


@pytest.mark.parametrize("a,b,want", [("US", "US", False), ("US", "GB", True), (None, "US", True), (None, None, True)])
def test_cross_border(spark, a, b, want):
    from pyspark.sql import functions as F

    from ordermart.functions.columns import is_cross_border

    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(is_cross_border(F.col("a"), F.col("b")).alias("x")).first()["x"] is want


def test_recognised_and_lost(spark):
    df = spark.createDataFrame([("delivered", Decimal("5")), ("refunded", Decimal("7")), ("pending", Decimal("9"))],
                               "order_status string, order_total_usd decimal(18,2)")
    got = [(r["recognised_revenue_usd"], r["lost_revenue_usd"]) for r in marts.recognise_revenue(df).collect()]
    assert got == [(Decimal("5.00"), Decimal("0.00")), (Decimal("0.00"), Decimal("7.00")), (Decimal("0.00"), Decimal("0.00"))]
