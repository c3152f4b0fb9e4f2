"""Keyed state that expires by timers: latest row and first row of each key.

Both run on ``transformWithState``. A row older than the watermark is dropped, the rest is
taken in event-time order. A key's state is one row and one timer; when the watermark
passes the time after which no row can change the result, the timer clears it. First rows
are kept by slots, hash parts of the keys: a slot's state holds the keys that were seen and
when each is forgotten, its one timer the next of these times, so the calls to the state
store follow the slots of a micro-batch and not its keys. So state
holds the keys of the last ``horizon`` only, not all keys ever seen, and with the RocksDB
store it lies on disk beside the executor and, by its change log, in the checkpoint.

Nulls: a row without event time, or with a null key, is no observation and is left out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from obs_engine.streaming.flows import event_time

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Hash parts of the keys whose first rows are kept.
SLOTS = 4096


def micros(value: datetime) -> int:
    value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    delta = value - EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


class Expiring(StatefulProcessor):
    """One remembered row per key; subclasses say which rows come out and when it is forgotten."""

    #: Columns beside the key, in order; the first two are the order of rows within a key.
    def __init__(self, state: StructType, columns: Sequence[str]):
        self.state, self.columns = state, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        live = [r for r in rows if r["event_micros"] >= mark * 1000]
        if not live:
            return
        live.sort(key=lambda r: (r["event_micros"], r["tie"]))
        chosen = self.choose(self.kept.get(), live)
        if chosen is None:
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.kept.update((chosen["event_micros"], chosen["tie"]))
        self.handle.registerTimer(self.until(chosen))
        yield Row(**{**{k: v for k, v in zip(self.key_names, key)}, **{c: chosen[c] for c in self.columns}})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        return iter(())

    def choose(self, kept: tuple | None, rows: list[Row]) -> Row | None:
        raise NotImplementedError

    def until(self, row: Row) -> int:
        """Milliseconds of the watermark from which on no row of the key can matter."""
        raise NotImplementedError


class LatestRow(Expiring):
    def choose(self, kept, rows):
        last = rows[-1]
        return last if kept is None or (last["event_micros"], last["tie"]) > (kept[0], kept[1]) else None

    def until(self, row):
        # Rows that are not too late are newer from then on.
        return row["event_micros"] // 1000 + 1


class FirstRows(StatefulProcessor):
    """The first row of each key of a slot; a key is remembered until its first row's ``last_millis``."""

    def __init__(self, key: Sequence[str], columns: Sequence[str]):
        self.key_names, self.columns = list(key), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", StructType([StructField("keys", BinaryType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        live = [r for r in rows if r["event_micros"] >= mark * 1000]
        if not live:
            return
        live.sort(key=lambda r: (r["event_micros"], r["tie"]))
        known = self.known()
        before, soonest = len(known), min(known.values(), default=None)
        for r in live:
            name = tuple(r[c] for c in self.key_names)
            if name not in known:
                known[name] = r["last_millis"]
                yield Row(**{c: r[c] for c in [*self.key_names, *self.columns]})
        if len(known) > before:
            self.keep(known)
            self.wake(min(known.values()), soonest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
        known = {k: until for k, until in self.known().items() if until >= mark}
        if known:
            self.keep(known)
            self.wake(min(known.values()), None)
        else:
            self.kept.clear()
        return iter(())

    def known(self) -> dict[tuple, int]:
        stored = self.kept.get()
        return pickle.loads(bytes(stored[0])) if stored else {}

    def keep(self, known: dict[tuple, int]) -> None:
        self.kept.update((pickle.dumps(known),))

    def wake(self, at: int, planned: int | None) -> None:
        if at == planned:
            return
        if planned is not None:
            self.handle.deleteTimer(planned)
        self.handle.registerTimer(at)


def _timed(df: DataFrame, key: Sequence[str], ts: str, tie: str, horizon: str, last) -> DataFrame:
    """Rows that are observations, with the columns that the processors go by."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        event_time(df, ts).dropna(subset=[ts, *key]).withWatermark(ts, horizon)
        .withColumn("event_micros", F.unix_micros(ts)).withColumn("tie", F.coalesce(F.col(tie).cast("long"), F.lit(-1)))
        .withColumn("last_millis", last)
    )


def expiring_latest(df: DataFrame, key: Sequence[str], ts: str, tie: str, horizon: str) -> DataFrame:
    """Each key's newest row whenever it changes, by ``ts`` and the whole number ``tie``."""
    rows = _timed(df, key, ts, tie, horizon, F.lit(0).cast("long"))
    columns = [c for c in df.columns if c not in key]
    run = LatestRow(StructType.fromDDL("event_micros BIGINT, tie BIGINT"), columns)
    run.key_names = list(key)
    out = StructType([rows.schema[c] for c in [*key, *columns]])
    return rows.groupBy(*key).transformWithState(run, out, "Update", "EventTime")


def expiring_first(df: DataFrame, key: Sequence[str], ts: str, tie: str, horizon: str, last: str) -> DataFrame:
    """The first row of each key that arrives, later ones are left out.

    ``last`` is a column with the latest event time a row of the key can have; state is
    kept until the watermark is past it.
    """
    rows = _timed(df, key, ts, tie, horizon, F.unix_millis(F.col(last).cast("timestamp")) + 1)
    columns = [c for c in df.columns if c not in key]
    out = StructType([rows.schema[c] for c in [*key, *columns]])
    slots = rows.withColumn("_slot", F.pmod(F.xxhash64(*key), F.lit(SLOTS)))
    return slots.groupBy("_slot").transformWithState(FirstRows(key, columns), out, "Update", "EventTime")
