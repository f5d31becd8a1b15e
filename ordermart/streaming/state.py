"""Keyed state for the stream scorer (J5, J7, B12): known ids, then cards.

Duplicates are told apart first, in a keyed step of their own (``transformWithStateInPandas``, RocksDB): ids are dealt by hash to
``ID_BUCKETS`` state rows, each with a 64-bit hash and the time of the ids of the id memory,
so the memory of a card that has a third of all events is spread over all
rows, and a lookup is vectorised (one call per bucket and batch, not per id).

Cards are dealt by hash to ``CARD_BUCKETS`` state rows as well, so the number of Python calls and state rows of a batch does not grow
with the number of cards; all cards of a bucket are scored together. Per card the state then holds only the events of the retention
horizon (velocity frame + lateness): event time (micros), id, latitude, longitude; and the newest event
already pruned (the carry), so the previous position is known after an idle
period. For
each micro-batch a card's new events are scored against state + earlier
events of the batch, *then* added (scored before the update, as the reference
does):

* ``tx_count_1min`` / ``tx_count_5min`` - earlier events (by event time) in
  ``[t - 60 s, t)`` / ``[t - 300 s, t)``;
* ``last_*`` - the previous event by (event time, id);
* ``_status`` - ``duplicate`` when the id is in the id memory (or
  earlier in the batch), else ``late`` when the event lies before the horizon
  of the card's newest event (it gets the counts known at arrival), else
  ``on_time``.

No event is dropped: there is no event-time watermark, so nothing is filtered
before this function, however late it is, and a long gap in event time changes
nothing. State is bounded by the horizon per card and the id memory per bucket (older than the bucket's newest
event by more than the memory: forgotten), and a card idle for
``position_ttl_days`` (processing time) is forgotten; the batch form knows no
such limit, so a card that returns later has no previous position here. An event
time far in the future would make all later events late; the source rejects
those (:func:`source.reject_future`). Work per group is vectorised (numpy).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ordermart.functions import fixed

#: Of a bucket of cards: the events kept (card number, ts, lat, lon: numpy bytes; ids: Arrow strings) and its cards (Arrow:
#: card_id, carry, and the processing time of the last event).
STATE_SCHEMA = "card_number binary, ts binary, ids binary, lat binary, lon binary, cards binary"
CARD_COLUMNS = pa.schema([("card_id", pa.string()), ("carry_ts", pa.int64()), ("carry_id", pa.string()),
                          ("carry_lat", pa.float64()), ("carry_lon", pa.float64()), ("active_ms", pa.int64())])
ID_COLUMN = pa.schema([("id", pa.string())])
ID_STATE_SCHEMA = "seen array<bigint>, seen_ts array<bigint>"
ID_BUCKETS, CARD_BUCKETS = 1024, 256
PASS_THROUGH = [
    ("transaction_id", "string"), ("card_id", "string"), ("customer_id", "string"),
    ("merchant_id", "string"), ("amount_usd", "decimal(18,4)"), ("merchant_category", "string"),
    ("device_fingerprint", "string"), ("latitude", "float"), ("longitude", "float"),
    ("event_time", "string"), ("event_ts", "timestamp"),
]
OUTPUT_SCHEMA = ", ".join(f"{n} {t}" for n, t in PASS_THROUGH) + (
    ", tx_count_1min bigint, tx_count_5min bigint, last_latitude float, last_longitude float, "
    "last_tx_timestamp timestamp, _status string"
)


MARKED_SCHEMA = ", ".join(f"{n} {t}" for n, t in PASS_THROUGH) + ", _again boolean"


class KnownIds(StatefulProcessor):
    """Mark the events whose id is known; the first arrival of an id counts. One value of state per
    bucket, expired when the bucket is idle."""

    def __init__(self, memory_us: int, ttl_ms: int):
        self.memory_us, self.ttl_ms = memory_us, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ids", ID_STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, seen_ts = (np.asarray(x, dtype="int64") for x in (self.state.get() if self.state.exists() else ([], [])))
        for pdf in rows:
            if pdf.empty:
                continue
            hashes = pdf["id_hash"].to_numpy(dtype="int64")
            again = np.ones(len(pdf), bool)
            again[np.unique(hashes, return_index=True)[1]] = False
            again |= np.isin(hashes, seen)
            times = pdf["event_ts"].astype("datetime64[us]").astype("int64").to_numpy()
            seen, seen_ts = np.concatenate([seen, hashes[~again]]), np.concatenate([seen_ts, times[~again]])
            out = pdf[[n for n, _ in PASS_THROUGH]].copy()
            out["_again"] = again
            yield out
        if len(seen):
            known = seen_ts >= seen_ts.max() - self.memory_us
            self.state.update((seen[known].tolist(), seen_ts[known].tolist()))

    def close(self) -> None:
        pass


def _packed(df: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.Table.from_pandas(df, schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_all().to_pandas(integer_object_nulls=True)


def _before(card: np.ndarray, t: np.ndarray, all_card: np.ndarray, all_t: np.ndarray) -> np.ndarray:
    """For each (card, t) the number of events (all_card, all_t) of smaller cards, or of the card and earlier than t."""
    is_event = np.repeat([False, True], [len(t), len(all_t)])
    order = np.lexsort((is_event, np.concatenate([t, all_t]), np.concatenate([card, all_card])))
    events = np.cumsum(is_event[order])
    out = np.empty(len(order), "int64")
    out[order] = events
    return out[:len(t)]


def _velocity_fn(short_us: int, long_us: int, horizon_us: int, position_ttl_ms: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # no event of any of its cards for so long
            state.remove()
            return
        frames = [p for p in pdfs if not p.empty]
        if not frames:
            return
        arrived = pd.concat(frames, ignore_index=True)

        again = arrived["_again"].to_numpy(dtype=bool)
        if again.any():
            rest = arrived.loc[again, [n for n, _ in PASS_THROUGH]].copy()
            for c in ("tx_count_1min", "tx_count_5min"):
                rest[c] = np.int64(0)
            for c in ("last_latitude", "last_longitude"):
                rest[c] = np.full(len(rest), np.nan, dtype="float32")
            rest["last_tx_timestamp"] = pd.Series(pd.NaT, index=rest.index, dtype="datetime64[us]")
            rest["_status"] = "duplicate"
            yield rest
        batch = arrived.loc[~again].reset_index(drop=True)
        if batch.empty:
            if state.exists:
                state.setTimeoutDuration(position_ttl_ms)
            return
        if state.exists:
            h_c, h_t, h_id, h_lat, h_lon, cards = state.get
            h_c, h_t, h_lat, h_lon = (np.frombuffer(bytes(x), d) for x, d in (
                (h_c, "int64"), (h_t, "int64"), (h_lat, "float64"), (h_lon, "float64")))
            h_id, cards = _unpacked(h_id)["id"].to_numpy(dtype=object), _unpacked(cards)
        else:
            h_c, h_t, h_lat, h_lon = (np.empty(0, d) for d in ("int64", "int64", "float64", "float64"))
            h_id, cards = np.empty(0, object), pd.DataFrame({c: [] for c in CARD_COLUMNS.names})
        # cards are numbered by their row in the state, new ones after them
        numbers, names = pd.factorize(np.concatenate([cards["card_id"].to_numpy(dtype=object), batch["card_id"].to_numpy(dtype=object)]))
        c_new, n_known, n_cards = numbers[len(cards):].astype("int64"), len(cards), len(names)
        carried = np.zeros(n_cards, bool)
        carried[:n_known] = cards["carry_ts"].notna()
        carry_t = np.zeros(n_cards, "int64")
        carry_t[:n_known][carried[:n_known]] = cards["carry_ts"][carried[:n_known]].astype("int64")
        carry_id = np.full(n_cards, None, object)
        carry_id[:n_known] = cards["carry_id"]
        carry_lat, carry_lon = np.full(n_cards, np.nan), np.full(n_cards, np.nan)
        carry_lat[:n_known], carry_lon[:n_known] = cards["carry_lat"].astype("float64"), cards["carry_lon"].astype("float64")

        t_new = batch["event_ts"].astype("datetime64[us]").astype("int64").to_numpy()
        all_c = np.concatenate([h_c, c_new])
        all_t = np.concatenate([h_t, t_new])
        all_id = np.concatenate([h_id, batch["transaction_id"].to_numpy(dtype=object)])
        all_lat = np.concatenate([h_lat, batch["latitude"].astype("float64").to_numpy()])
        all_lon = np.concatenate([h_lon, batch["longitude"].astype("float64").to_numpy()])
        order = np.lexsort((all_id.astype(str), all_t, all_c))
        all_c, all_t, all_id, all_lat, all_lon = (x[order] for x in (all_c, all_t, all_id, all_lat, all_lon))

        # of the card, strictly earlier by time, inside the frame
        right, short, long = np.split(_before(
            np.tile(c_new, 3), np.concatenate([t_new, t_new - short_us, t_new - long_us]), all_c, all_t), 3)
        # previous by (time, id): where each new event landed in the sorted
        # merge (inverse permutation), minus one, if that is of the card
        inv = np.empty_like(order)
        inv[order] = np.arange(order.size)
        pos = inv[h_t.size:] - 1
        has_prev = (pos >= 0) & (all_c[np.maximum(pos, 0)] == c_new)
        prev = np.maximum(pos, 0)
        out = batch[[n for n, _ in PASS_THROUGH]].copy()
        out["tx_count_1min"] = right - short
        out["tx_count_5min"] = right - long
        valid_prev = has_prev | carried[c_new]
        last_lat = np.where(has_prev, all_lat[prev], carry_lat[c_new])
        last_lon = np.where(has_prev, all_lon[prev], carry_lon[c_new])
        last_t = np.where(has_prev, all_t[prev], carry_t[c_new])
        out["last_latitude"] = pd.Series(np.where(valid_prev, last_lat, np.nan)).astype("float32")
        out["last_longitude"] = pd.Series(np.where(valid_prev, last_lon, np.nan)).astype("float32")
        out["last_tx_timestamp"] = pd.to_datetime(
            pd.Series(np.where(valid_prev, last_t, np.iinfo("int64").min)), unit="us", errors="coerce")
        out.loc[~valid_prev, "last_tx_timestamp"] = pd.NaT
        newest = carry_t.clip(0)  # before this batch
        np.maximum.at(newest, h_c, h_t)
        out["_status"] = np.where(t_new < newest[c_new] - horizon_us, "late", "on_time")

        # update: keep the horizon, move each card's newest pruned event into its carry
        last = np.flatnonzero(np.append(all_c[1:] != all_c[:-1], True))
        cutoff = np.zeros(n_cards, "int64")
        cutoff[all_c[last]] = all_t[last] - horizon_us
        keep = all_t >= cutoff[all_c]
        pruned = np.flatnonzero(~keep)
        pruned = pruned[np.append(all_c[pruned][1:] != all_c[pruned][:-1], True)[:len(pruned)]]
        pruned = pruned[~carried[all_c[pruned]] | (all_t[pruned] >= carry_t[all_c[pruned]])]
        at = all_c[pruned]
        carried[at], carry_t[at], carry_id[at] = True, all_t[pruned], all_id[pruned]
        carry_lat[at], carry_lon[at] = all_lat[pruned], all_lon[pruned]
        now = state.getCurrentProcessingTimeMs()
        active = np.full(n_cards, now, "int64")
        active[:n_known] = cards["active_ms"].astype("int64")
        active[c_new] = now
        stays = active > now - position_ttl_ms
        number = np.cumsum(stays) - 1  # of the cards that stay
        keep &= stays[all_c]
        state.update((
            number[all_c[keep]].astype("int64").tobytes(), all_t[keep].tobytes(), _packed(pd.DataFrame({"id": all_id[keep]}), ID_COLUMN),
            all_lat[keep].tobytes(), all_lon[keep].tobytes(),
            _packed(pd.DataFrame({
                "card_id": np.asarray(names, object), "carry_ts": pd.array(np.where(carried, carry_t, 0), "Int64"), "carry_id": carry_id,
                "carry_lat": carry_lat, "carry_lon": carry_lon, "active_ms": active}).assign(
                    carry_ts=lambda d: d["carry_ts"].mask(~carried))[stays], CARD_COLUMNS)))
        state.setTimeoutDuration(position_ttl_ms)
        yield out

    return fn


def card_velocity_state(
    tx: DataFrame,
    short_seconds: int = fixed.VELOCITY_SHORT_SECONDS,
    long_seconds: int = fixed.VELOCITY_LONG_SECONDS,
    lateness_seconds: int = 600,
    id_memory_seconds: int = 86_400,
    position_ttl_days: int = fixed.PROFILE_TTL_DAYS,
    buckets: int = CARD_BUCKETS,
) -> DataFrame:
    """Ids marked by :func:`known_ids`, then ``applyInPandasWithState`` per bucket of cards over the decoded
    stream. ``buckets`` stays for the life of the checkpoint."""
    horizon = long_seconds + lateness_seconds
    fn = _velocity_fn(short_seconds * 1_000_000, long_seconds * 1_000_000, horizon * 1_000_000, position_ttl_days * 86_400_000)
    marked = known_ids(tx, max(horizon, id_memory_seconds), position_ttl_days)
    bucket = F.pmod(F.xxhash64("card_id"), F.lit(buckets)).cast("int")
    return marked.withColumn("card_bucket", bucket).groupBy("card_bucket").applyInPandasWithState(
        fn, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.ProcessingTimeTimeout)


def known_ids(tx: DataFrame, memory_seconds: int = 86_400, ttl_days: int = fixed.PROFILE_TTL_DAYS,
              buckets: int = ID_BUCKETS) -> DataFrame:
    """The decoded stream with ``_again``: whether the id came within the id memory."""
    hashed = F.xxhash64("transaction_id")
    rows = tx.select(*[n for n, _ in PASS_THROUGH], hashed.alias("id_hash"), F.pmod(hashed, F.lit(buckets)).cast("int").alias("id_bucket"))
    return rows.groupBy("id_bucket").transformWithStateInPandas(
        KnownIds(memory_seconds * 1_000_000, ttl_days * 86_400_000), MARKED_SCHEMA, "Append", "ProcessingTime")
