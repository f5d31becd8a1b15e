import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ordermart.session import get_spark

    s = get_spark("ordermart-tests", local=True, cores=4,
                  extra_conf={"spark.sql.shuffle.partitions": "8",
                              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ordermart-test-ckpt-")})
    yield s
    s.stop()


BRONZE_COLS = ["order_id", "customer_id", "order_status", "order_total_amount", "currency_code", "channel",
               "created_at", "updated_at", "shipping_country", "item_count", "_cdc_operation", "_ingestion_date",
               "_kafka_timestamp_ms"]


def bronze_row(order_id="ORD-001", customer_id="CUST-001", status="delivered", amount="150.00", currency="USD",
               channel="web", created_at="2024-03-15T10:30:00.000Z", updated_at="2024-03-15T14:00:00.000Z",
               country="US", items="3", ts_ms="1710511200000"):
    return (order_id, customer_id, status, amount, currency, channel, created_at, updated_at, country, items,
            "c", "2024-03-15", ts_ms)


@pytest.fixture
def make_bronze(spark):
    def make(rows):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_COLS))
    return make
