"""Accounts of a stream: what was sent, dropped as late, dropped as repeated and let through.

Spark drops rows that the watermark has passed without a word. ``counted`` puts counters before and
after the row-wise operators of a stream; a ``Ledger`` listens to its batches and adds up those
counters and the rows that each stateful operator dropped. Counters belong to a batch, and a batch
that runs again replaces its entry, so a restarted query isn't counted twice.

Rows are only dropped one by one where a row-wise stateful operator (de-duplication, keyed state)
meets them first: a windowed aggregation would count pre-aggregated rows.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

ENTRIES = "query_id string, batch_id long, sent long, passed long, late long, repeated long"


def counted(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a counter of its rows, read as the batch metric ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class Entry:
    sent: int
    passed: int
    late: int
    repeated: int


class Ledger(StreamingQueryListener):
    """Entries of the batches of all queries that run while it listens."""

    def __init__(self, sent: str = "sent", passed: str = "passed"):
        self.sent, self.passed = sent, passed
        self.entries: dict[tuple[str, int], Entry] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics
        states = progress.stateOperators
        entry = Entry(
            self._rows(seen, self.sent), self._rows(seen, self.passed), sum(s.numRowsDroppedByWatermark for s in states),
            sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in states),
        )
        with self._lock:
            self.entries[(str(progress.id), progress.batchId)] = entry

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def settle(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the query has ended and all its batches are entered: listeners lag behind."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.id} was reported within {seconds} s")

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per batch: a few numbers each."""
        with self._lock:
            rows = [(q, b, e.sent, e.passed, e.late, e.repeated) for (q, b), e in sorted(self.entries.items())]
        return spark.createDataFrame(rows, ENTRIES)

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row per query: the sums over its batches, and whether they add up."""
        names = ("sent", "passed", "late", "repeated")
        sums = self.table(spark).groupBy("query_id").agg(*[F.sum(n).alias(n) for n in names])
        return sums.withColumn("balanced", F.col("sent") == F.col("passed") + F.col("late") + F.col("repeated"))

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    @staticmethod
    def _rows(seen: dict, name: str) -> int:
        return seen[name]["rows"] if name in seen else 0


class listening:
    """``with listening(spark) as ledger``: a ledger that listens inside the block."""

    def __init__(self, spark: SparkSession, **names: str):
        self.spark, self.ledger = spark, Ledger(**names)

    def __enter__(self) -> Ledger:
        self.spark.streams.addListener(self.ledger)
        return self.ledger

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self.ledger)
