"""Facility status as keyed state: changes in event-time order, and facilities that fell silent.

Every facility has its own state in a RocksDB store: its status, the time of its newest event, and
the events of time blocks that the watermark hasn't passed. An event-time timer at a block's end
hands the block over: its events, now complete whatever order they came in, are compared one after
the other. A facility without an event for ``expiry`` is reported silent once, and its state is
dropped; what it sends later begins anew. Both follow from event times alone, so batches may be cut
anywhere. State per facility is bounded by the events of the delay plus one block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywater.functions import sensing
from tallywater.operators import sensors

# The processor travels to Python workers whole: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Changes are uploaded, not the whole store: state grows with the facilities, a batch doesn't.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
STATUSES = sensing.FACILITY_STATUS
#: Rows of a facility that are handed to the store at once.
BUNDLE = 200_000
CHANGES = "timestamp timestamp, facility_name string, event_id string, previous_status string, status string, kind string"
MICROS = 1_000_000


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Start streams with keyed state inside: they keep the settings they were started with."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class StatusProcessor(StatefulProcessor):
    """Changes of one facility's status; rows are (moment, event_id), see ``sensing.moment``."""

    def __init__(self, block: int, expiry: int):
        self.block, self.expiry = block, expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = handle.getValueState("current", "severity int, micros long")
        self.waiting = handle.getMapState("waiting", "block long, bundle long", "moments array<long>, event_ids array<string>")
        self.bundles = handle.getValueState("bundles", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, size, number, timers = [], 0, self.bundles.get()[0] if self.bundles.exists() else 0, set()
        for part in rows:
            held.append(part)
            size += len(part)
            if size >= BUNDLE:
                self._put(held, number, timers)
                held, size, number = [], 0, number + 1
        if held:
            self._put(held, number, timers)
            number += 1
        self.bundles.update((number,))
        return iter(())

    def _put(self, parts: list[pd.DataFrame], bundle: int, timers: set[int]) -> None:
        """Events beside those of their blocks that are there: nothing is read back to be written longer."""
        every = pd.concat(parts, ignore_index=True).dropna(subset=["moment"]).astype({"moment": "int64"})
        for number, group in every.groupby((every["moment"] // 4) // self.block):
            block = int(number)
            self.waiting.updateValue((block, bundle), (group["moment"].tolist(), group["event_id"].tolist()))
            if block not in timers:
                timers.add(block)
                self.handle.registerTimer(self._millis((block + 1) * self.block))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Events before the frontier are all here; a timer may stand for several blocks.
        frontier = timerValues.getCurrentWatermarkInMs() * 1000 // self.block
        ready: dict[int, list[int]] = {}
        for block, bundle in self.waiting.keys():
            if block < frontier:
                ready.setdefault(block, []).append(bundle)
        severity, micros = self.current.get() if self.current.exists() else (None, None)
        out: list[tuple] = []
        for number in sorted(ready):
            events: list[tuple] = []
            for bundle in sorted(ready[number]):
                moments, ids = self.waiting.getValue((number, bundle))
                events.extend(zip(moments, ids))
                self.waiting.removeKey((number, bundle))
            for moment, event_id in sorted(events, key=lambda e: (e[0], e[1] or "")):
                at, now = moment // 4, moment % 4
                if micros is not None and at >= micros + self.expiry:
                    out.append((micros + self.expiry, None, severity, None, "silent"))
                    severity = None
                if now != severity:
                    out.append((at, event_id, severity, now, "change"))
                severity, micros = now, at
        if micros is not None and micros + self.expiry <= frontier * self.block:
            out.append((micros + self.expiry, None, severity, None, "silent"))
            self.current.clear()
            if not any(True for _ in self.waiting.keys()):
                self.bundles.clear()
        elif ready:
            self.current.update((int(severity), int(micros)))
            # The first frontier at which the facility would be silent.
            self.handle.registerTimer(self._millis(-(-(micros + self.expiry) // self.block) * self.block))
        if out:
            yield self._frame(key[0], out)

    def close(self) -> None:
        pass

    @staticmethod
    def _millis(micros: int) -> int:
        return int(-(-micros // 1000))

    @staticmethod
    def _frame(facility: str, rows: list[tuple]) -> pd.DataFrame:
        at, ids, before, now, kind = zip(*rows)

        def named(severities):
            return [None if s is None else STATUSES[s] for s in severities]

        return pd.DataFrame(
            {
                "timestamp": pd.to_datetime(pd.Series(at), unit="us"), "facility_name": facility, "event_id": ids,
                "previous_status": named(before), "status": named(now), "kind": kind,
            }
        )


def status_states(
    events: DataFrame, block: timedelta = timedelta(minutes=1), expiry: timedelta = timedelta(hours=1), delay: str = "1 minute"
) -> DataFrame:
    """Status changes of every facility and the times at which facilities fell silent (append mode).

    To be started inside ``keyed_state``. Of events at the same instant the worse status comes last,
    then the larger id; events that the watermark has passed are dropped and counted by Spark
    (see ``ledger``).
    """
    length, silence = (int(t / timedelta(microseconds=1)) for t in (block, expiry))
    rows = events.withWatermark("timestamp", delay).select(
        "timestamp", F.coalesce("facility.name", F.lit("")).alias("facility_name"), "event_id",
        sensing.moment("timestamp", sensors.event_status()).alias("moment"),
    )
    return rows.groupBy("facility_name").transformWithStateInPandas(
        StatusProcessor(length, silence), CHANGES, "Append", "eventTime"
    )
