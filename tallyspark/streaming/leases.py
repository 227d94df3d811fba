"""Leases by heartbeat: an owner is dropped by a timer, without any further beat, and its state goes with it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Leases(StatefulProcessor):
    """State of a key: its owner, since when, and the end of its lease in milliseconds. A timer stands at that end."""

    def __init__(self, key: str, host: str, stamp: str, lease: int):
        self.key, self.host, self.stamp, self.lease = key, host, stamp, lease * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lease", "owner string, since long, until long")

    def told(self, key, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=["owner", "event", "at"])
            out["at"] = pd.to_datetime(out["at"], unit="ms")
            out.insert(0, self.key, key[0])
            yield out

    def handleInputRows(self, key, rows, timerValues):
        before = self.state.get() if self.state.exists() else None
        owner, since, until = before if before else (None, None, None)
        events = []
        beats = pd.concat(list(rows)).sort_values([self.stamp, self.host])
        for at, who in zip(beats[self.stamp].astype("datetime64[ms]").astype("int64"), beats[self.host].astype(str), strict=True):
            if owner is not None and at > until:
                events.append((owner, "dropped", until))
                owner = None
            if owner is None:
                owner, since, until = who, at, at + self.lease
                events.append((who, "claimed", at))
            elif who == owner:
                until = max(until, at + self.lease)
        if before and before[2] != until:
            self.handle.deleteTimer(before[2])
        if not before or before[2] != until:
            self.handle.registerTimer(until)
        self.state.update((owner, since, until))
        yield from self.told(key, events)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            owner, _, until = self.state.get()
            if until <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
                yield from self.told(key, [(owner, "dropped", until)])

    def close(self) -> None:
        pass


def lease_events(beats: DataFrame, key: str, host: str, stamp: str, lease: int = 1800, late: str = "1 minute") -> DataFrame:
    """key, owner, event (claimed or dropped), at: of a stream of heartbeats, who holds each key from when and until when.

    A free key goes to the first host to beat; a holder keeps it by beating again within `lease` seconds, and other hosts'
    beats count for nothing meanwhile. When the watermark passes the end of a lease its holder is dropped by a timer and
    the key's state is gone, whether or not anyone beats again. Beats older than the watermark are left out. What is kept
    is one row for each key that is held. Beats come from a session of with_timers().
    """
    kind = beats.schema[key].dataType.simpleString()
    rows = beats.select(key, host, stamp).withWatermark(stamp, late)
    return rows.groupBy(key).transformWithStateInPandas(_Leases(key, host, stamp, lease), f"{key} {kind}, owner string, event string, at timestamp", "append", "eventTime")


def with_timers(spark: SparkSession) -> SparkSession:
    """A session beside the caller's that keeps state where timers can be kept, in as many partitions as there are cores, each
    of which is a Python worker; streams of leases start from it."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return own
