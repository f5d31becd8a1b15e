"""Nightly profile versions for a running scorer.

Each night's profile tables are parts of versioned tables (``as_of=<night>``). A micro-batch
resolves the versions when it runs: an event takes the latest night before its own date, if that is at
most ``ttl_days`` old; so a new night is used by the next batch without a restart, a replayed
batch finds the night that its events belong to, and a night that has expired is not used however
long no other came. Only the nights a batch needs are read, and of them only its cards go
into the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.sinks.versions import VersionedTable, part_name

TABLES = ("amounts", "devices", "categories")


class ProfileStore:
    def __init__(self, spark: SparkSession, root: str, ttl_days: int = fixed.PROFILE_TTL_DAYS):
        self.spark, self.ttl_days = spark, ttl_days
        self.tables = {name: VersionedTable(spark, f"{root}/{name}") for name in TABLES}

    def publish(self, profile: dict[str, DataFrame], night: str) -> None:
        """Add (or replace) a night; nights that no event of its morrow may use any more go."""
        for name, table in self.tables.items():
            base = table.head()
            gone = [p for p in base.parts if p.split("=")[1] < str(self._oldest(night))] if base else []
            table.write(profile[name].withColumn("as_of", F.lit(str(night)).cast("date")), "as_of", base,
                        [part_name("as_of", night), *gone], meta={"nights": sorted({*(base.meta["nights"] if base else []), str(night)})})

    def _oldest(self, night: str):
        return self.spark.range(1).select(F.date_sub(F.lit(str(night)).cast("date"), 2 * self.ttl_days)).first()[0]

    def heads(self) -> dict:
        return {name: table.head() for name, table in self.tables.items()}

    def enrich(self, batch: DataFrame) -> DataFrame:
        """``batch`` with the profile columns of each event's night."""
        heads = self.heads()
        known = [set(v.meta["nights"]) if v else set() for v in heads.values()]
        nights = sorted(set.intersection(*known), reverse=True)  # published in all tables
        day = F.to_date("event_ts")
        as_of = F.lit(None).cast("date")
        for night in reversed(nights):  # the latest is asked first
            n = F.lit(night).cast("date")
            as_of = F.when((day > n) & (F.date_diff(day, n) <= self.ttl_days), n).otherwise(as_of)
        dated = batch.withColumn("as_of", as_of)
        used = [r[0] for r in dated.select("as_of").where("as_of IS NOT NULL").distinct().collect()]  # a row a night
        cards = dated.select("card_id", "as_of").distinct()

        def of(name: str, *columns) -> DataFrame:
            if not heads[name]:
                return self.spark.createDataFrame([], self._empty(name))
            parts = [part_name("as_of", n) for n in used]
            return self.tables[name].read(parts, heads[name]).join(cards, ["card_id", "as_of"], "left_semi").select("card_id", "as_of", *columns)

        devices = of("devices", "device_fingerprint").withColumn("device_seen_90d", F.lit(True))
        categories = of("categories", "merchant_category").withColumn("category_seen_30d", F.lit(True))
        return (dated.join(of("amounts", "amount_sum_30d", "amount_count_30d"), ["card_id", "as_of"], "left")
                .join(devices, ["card_id", "as_of", "device_fingerprint"], "left")
                .join(categories, ["card_id", "as_of", "merchant_category"], "left")
                .withColumn("amount_count_30d", F.coalesce("amount_count_30d", F.lit(0)))
                .withColumn("amount_sum_30d", F.coalesce("amount_sum_30d", F.lit(0).cast("decimal(28,4)"))))

    @staticmethod
    def _empty(name: str) -> str:
        return "card_id string, as_of date, " + {
            "amounts": "amount_sum_30d decimal(28,4), amount_count_30d bigint", "devices": "device_fingerprint string",
            "categories": "merchant_category string"}[name]
