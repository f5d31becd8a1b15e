from datetime import datetime

from pyspark.sql import functions as F

from ordermart.operators import change

SRC = "customer_id string, customer_tier string, customer_updated_at timestamp"


def test_merge_twice_equals_once(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "order_id string, v int")
    u = spark.createDataFrame([("b", 20), ("c", 30)], "order_id string, v int")
    once = change.merge_upsert(t, u)
    twice = change.merge_upsert(once, u)
    assert sorted(once.collect()) == sorted(twice.collect()) == [("a", 1), ("b", 20), ("c", 30)]


def test_incremental_lookback(spark):
    from datetime import date

    t = spark.createDataFrame([(date(2024, 1, 10),)], "order_date date")
    s = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 15)], "order_date date")
    wm = change.read_target_watermark(t)
    assert change.incremental_lookback(s, wm).count() == 8  # days 7 .. 14 (watermark 10 - 3)
    assert change.incremental_lookback(s, None).count() == 14


def test_scd2_step_cases(spark):
    d = datetime
    snap = change.scd2_initial(spark.createDataFrame(
        [("same", "gold", d(2024, 1, 1)), ("chg", "silver", d(2024, 1, 1)), ("gone", "bronze", d(2024, 1, 1))], SRC))
    src = spark.createDataFrame([("same", "gold", d(2024, 1, 1)), ("chg", "gold", d(2024, 3, 1)),
                                 ("new", "bronze", d(2024, 4, 1))], SRC)
    out = change.scd2_apply(snap, src, "2024-05-01 00:00:00")
    rows = sorted((r["customer_id"], r["customer_tier"], r["valid_from"], r["valid_to"]) for r in out.collect())
    assert rows == [
        ("chg", "gold", d(2024, 3, 1), None),
        ("chg", "silver", d(2024, 1, 1), d(2024, 3, 1)),
        ("gone", "bronze", d(2024, 1, 1), d(2024, 5, 1)),
        ("new", "bronze", d(2024, 4, 1), None),
        ("same", "gold", d(2024, 1, 1), None),
    ]
    again = change.scd2_apply(out, src, "2024-05-01 00:00:00")
    assert sorted(again.collect()) == sorted(out.collect())  # rerun changes nothing


def test_changelog_intervals_do_not_overlap(spark):
    from ordermart.operators.marts import stage_customers
    from ordermart.sources import adapters as A

    h = change.scd2_from_changelog(stage_customers(A.customer_versions(
        A.load_table(spark, "/root/testdata/sf0.001", "customer"))))
    rows = sorted((r["customer_id"], r["valid_from"], r["valid_to"]) for r in h.collect())
    by = {}
    for c, f, t in rows:
        by.setdefault(c, []).append((f, t))
    for spans in by.values():
        assert spans[-1][1] is None
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 == f2 and f1 < t1


def test_as_of_join(spark):
    d = datetime
    hist = spark.createDataFrame([("a", "silver", d(2024, 1, 1), d(2024, 3, 1)), ("a", "gold", d(2024, 3, 1), None)],
                                 "customer_id string, customer_tier string, valid_from timestamp, valid_to timestamp")
    facts = spark.createDataFrame([("o1", "a", d(2024, 2, 1)), ("o2", "a", d(2024, 3, 1)), ("o3", "a", d(2023, 1, 1))],
                                  "order_id string, customer_id string, ts timestamp")
    got = {r["order_id"]: r["customer_tier_at_event"] for r in change.as_of_join(facts, hist, "customer_id", "ts").collect()}
    assert got == {"o1": "silver", "o2": "gold", "o3": None}
