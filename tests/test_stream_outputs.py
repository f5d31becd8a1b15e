"""Batch ledger, compaction, folded windows, nightly profiles, id memory."""

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordermart.session import scratch_path
from ordermart.sinks import versions
from ordermart.streaming import outputs, scorer, state
from ordermart.streaming.profiles import ProfileStore
from test_versions import Stopped, stop_at


def write(spark, root, batch, rows, commit=True):
    df = spark.createDataFrame(rows, "transaction_id string, event_date string").withColumn("event_date", F.to_date("event_date"))
    df.coalesce(1).write.mode("overwrite").parquet(f"{root}/audit/run=r/batch_id={batch}")
    if commit:
        outputs.commit_batch(spark, root, "r", batch)


def read(spark, root):
    return Counter(r.transaction_id for r in outputs.read_output(spark, root, "audit").collect())


def test_readers_see_committed_batches_once(spark):
    root = scratch_path(spark, "ledger")
    write(spark, root, 0, [("a", "2024-01-01")])
    write(spark, root, 1, [("b", "2024-01-01"), ("c", "2024-01-02")], commit=False)  # failed before the end
    assert read(spark, root) == Counter("a")
    write(spark, root, 1, [("b", "2024-01-01"), ("c", "2024-01-02")])  # the replay
    write(spark, root, 1, [("b", "2024-01-01"), ("c", "2024-01-02")])  # and one more
    assert read(spark, root) == Counter("abc")
    assert outputs.compact(spark, root, "audit") == 2 and outputs.compact(spark, root, "audit") == 0
    write(spark, root, 2, [("d", "2024-01-02")])
    assert read(spark, root) == Counter("abcd")


def test_compaction_stopped_anywhere(spark, monkeypatch):
    def prepare():
        root = scratch_path(spark, "ledger")
        for b, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-02")):
            write(spark, root, b, [(f"t{b}", day)])
            if b < 2:
                outputs.compact(spark, root, "audit")
        return root

    whole = Counter(["t0", "t1", "t2"])
    root = prepare()
    with monkeypatch.context() as m:
        calls = stop_at(m, -2)
        outputs.compact(spark, root, "audit")
    for number in range(2 * calls[0]):
        root = prepare()
        with monkeypatch.context() as m:
            stop_at(m, number)
            with pytest.raises(Stopped):
                outputs.compact(spark, root, "audit")
        assert read(spark, root) == whole, number
        outputs.compact(spark, root, "audit")
        assert read(spark, root) == whole, number


def test_folders_do_not_grow_with_batches(spark):
    root = scratch_path(spark, "ledger")
    for b in range(12):
        write(spark, root, b, [(f"t{b}", f"2024-01-0{1 + b % 2}")])
        if b % 3 == 2:
            outputs.compact(spark, root, "audit")
    assert len(versions.list_folder(spark, f"{root}/audit/run=r")) <= 4
    table = versions.VersionedTable(spark, f"{root}/_compacted/audit")
    assert sorted(table.head().parts) == ["event_date=2024-01-01", "event_date=2024-01-02"]
    assert read(spark, root) == Counter(f"t{b}" for b in range(12))


def test_folded_windows_take_late_counts(spark):
    root = scratch_path(spark, "windows")
    sink = scorer.write_window_counts(root)
    start = dt.datetime(2024, 1, 1, 10)

    def batch(number, *cards):
        sink(spark.createDataFrame([(c, start, start + dt.timedelta(minutes=1)) for c in cards],
                                   "card_id string, window_start timestamp, window_end timestamp"), number)

    def totals():
        return {r.card_id: r.tx_count for r in scorer.window_totals(spark, root).collect()}

    batch(0, "A", "A", "B")
    assert totals() == {"A": 2, "B": 1}
    assert scorer.fold_windows(spark, root) == 1 and totals() == {"A": 2, "B": 1}
    batch(1, "A")  # late
    batch(1, "A")  # replayed
    batch(2, "C")
    assert totals() == {"A": 3, "B": 1, "C": 1}
    assert scorer.fold_windows(spark, root) == 2 and totals() == {"A": 3, "B": 1, "C": 1}
    assert len(outputs._new(spark, root, versions.VersionedTable(spark, f"{root}/_compacted/windows").head())) == 0


def test_each_event_takes_the_latest_night_before_it(spark):
    store = ProfileStore(spark, scratch_path(spark, "profile"), ttl_days=10)
    events = spark.createDataFrame([(f"T{d}", "A", "D", "web", f"2024-01-{d:02d} 12:00:00") for d in (1, 2, 3, 6, 15, 20)],
                                   "transaction_id string, card_id string, device_fingerprint string, merchant_category string, t string"
                                   ).withColumn("event_ts", F.to_timestamp("t")).drop("t")

    def counts():
        return {r.transaction_id: (r.amount_count_30d, r.device_seen_90d) for r in store.enrich(events).collect()}

    def profile(n):
        return {"amounts": spark.createDataFrame([("A", n), ("B", 99)], "card_id string, amount_count_30d bigint").withColumn(
                    "amount_sum_30d", F.lit(1).cast("decimal(28,4)")),
                "devices": spark.createDataFrame([("A", "D")], "card_id string, device_fingerprint string"),
                "categories": spark.createDataFrame([("B", "web")], "card_id string, merchant_category string")}

    none = {f"T{d}": (0, None) for d in (1, 2, 3, 6, 15, 20)}
    assert counts() == none
    store.publish(profile(1), "2024-01-01")
    assert counts() == none | {f"T{d}": (1, True) for d in (2, 3, 6)}  # not the night's own day, not after ten days
    store.publish(profile(2), "2024-01-05")
    store.publish(profile(3), "2024-01-05")  # again
    assert counts() == none | {"T2": (1, True), "T3": (1, True), "T6": (3, True), "T15": (3, True)}
    store.publish(profile(4), "2024-02-20")  # nights that nothing can use go
    assert sorted(store.tables["amounts"].head().parts) == ["as_of=2024-02-20"]


def test_ids_of_a_hot_card_are_spread_over_all_buckets():
    class Value:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    def events(n, first=0):
        ids = np.random.default_rng(1).integers(-2**63, 2**63 - 1, first + n)[first:]
        out = pd.DataFrame({c: [None] * n for c, _ in state.PASS_THROUGH})
        out["card_id"], out["event_ts"] = "hot", pd.Timestamp("2024-01-01")
        out["id_hash"] = ids
        return out.assign(id_bucket=ids % state.ID_BUCKETS)

    buckets = {}
    for landing in (events(300_000), events(100_000)):  # the second replays a third of the first
        again = 0
        for bucket, pdf in landing.groupby("id_bucket"):
            p = state.KnownIds(86_400_000_000, 1)
            p.state = buckets.setdefault(bucket, Value())
            again += sum(int(o["_again"].sum()) for o in p.handleInputRows((bucket,), iter([pdf]), None))
        assert again == (0 if len(landing) == 300_000 else 100_000)
    sizes = [len(v.value[0]) for v in buckets.values()]
    assert len(sizes) == state.ID_BUCKETS and sum(sizes) == 300_000 and max(sizes) < 450
    assert "ids" in state.STATE_SCHEMA and "seen" not in state.STATE_SCHEMA  # the card's row: its horizon only


def card_batches(seed, cards=5, batches=5, each=40):
    rng, number = np.random.default_rng(seed), 0
    for b in range(batches):
        out = pd.DataFrame({c: [None] * each for c, _ in state.PASS_THROUGH})
        out["transaction_id"] = [f"T{number + i}" for i in rng.permutation(each)]
        out["card_id"] = rng.choice([f"C{i}" for i in range(cards)], each)
        out["event_ts"] = pd.to_datetime(rng.integers(0, 60, each) * 20 + b * 700, unit="s").astype("datetime64[us]")
        out["latitude"] = out["longitude"] = rng.random(each).astype("float32")
        out["_again"] = rng.random(each) < 0.1
        number += each
        yield out


class CardState:
    hasTimedOut, value, now = False, None, 0
    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def setTimeoutDuration(self, ms):
        self.timeout = ms

    def getCurrentProcessingTimeMs(self):
        return self.now


def test_cards_of_a_bucket_are_scored_as_if_alone():
    fn = state._velocity_fn(60_000_000, 300_000_000, 900_000_000, 1000)
    columns = ["transaction_id", "tx_count_1min", "tx_count_5min", "last_latitude", "last_longitude", "last_tx_timestamp", "_status"]
    together, alone = CardState(), {}
    for batch in card_batches(3):
        got = pd.concat(fn((0,), iter([batch[:25], batch[25:]]), together))
        want = pd.concat([o for c, rows in batch.groupby("card_id") for o in fn((0,), iter([rows]), alone.setdefault(c, CardState()))])
        got, want = (x[columns].sort_values("transaction_id").reset_index(drop=True) for x in (got, want))
        pd.testing.assert_frame_equal(got, want)
        brute = batch[~batch["_again"]]
        if batch["transaction_id"].str[1:].astype(int).min() == 0:  # nothing known before
            t = brute["event_ts"]
            n = [int(((brute["card_id"] == c) & (t < x) & (t >= x - pd.Timedelta("300s"))).sum()) for c, x in zip(brute["card_id"], t)]
            assert dict(zip(brute["transaction_id"], n)).items() <= dict(zip(got["transaction_id"], got["tx_count_5min"])).items()


def test_idle_cards_leave_their_bucket():
    fn, st = state._velocity_fn(60_000_000, 300_000_000, 900_000_000, 1000), CardState()
    batch = next(card_batches(4)).assign(_again=False)
    cards = lambda: set(state._unpacked(st.value[5])["card_id"])
    for now, only in ((0, ["C0", "C1"]), (900, ["C1", "C2"]), (1500, ["C2"])):
        st.now = now
        list(fn((0,), iter([batch[batch["card_id"].isin(only)]]), st))
    assert cards() == {"C1", "C2"} and st.timeout == 1000
    assert set(np.frombuffer(st.value[0], "int64")) == {0, 1}


def test_landed_files_are_full_however_the_lines_are_spread(spark):
    from ordermart.streaming.source import land_capped

    path = scratch_path(spark, "capped")
    lines = spark.range(0, 25, 1, 4).select(F.concat(F.lit("line "), "id").alias("value")).where("value <> 'line 3'")
    assert land_capped(lines, path, 10) == 3
    rows = spark.read.text(path).select("value", F.input_file_name().alias("f")).collect()
    assert sorted(Counter(r.f for r in rows).values()) == [4, 10, 10]
    assert Counter(r.value for r in rows) == Counter(f"line {i}" for i in range(25) if i != 3)
    assert land_capped(lines.where("false"), scratch_path(spark, "capped"), 10) == 0
