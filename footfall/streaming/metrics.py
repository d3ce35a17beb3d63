"""Counts per micro-batch, taken while the stream runs and without a second scan.

``observe_decoded`` and ``observe_judged`` add counters to a stream's plan; Spark reports them with
the progress of each micro-batch. ``BatchCounts`` listens and keeps them:

    counts = BatchCounts()
    spark.streams.addListener(counts)
    ...
    counts.of("messages")   # {batch_id: {"accepted": 10, "rejected": 1}}

A micro-batch that is run again after a failure reports again and takes the place of its first
report. Counters count what a plan reads; inside ``foreachBatch`` a plan may be read several times,
so put them on streams that are written by a sink of their own.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observe_decoded(decoded: DataFrame, name: str = "messages") -> DataFrame:
    """Decoded messages, counted as accepted or rejected."""
    good = F.count_if(F.col("problem").isNull()).alias("accepted")
    return decoded.observe(name, good, F.count_if(F.col("problem").isNotNull()).alias("rejected"))


def observe_judged(judged: DataFrame, name: str = "sightings") -> DataFrame:
    """Judged sightings (``operators.horizon.judged``), counted as accepted, late or future."""
    reason = F.col("reason")
    good = F.count_if(reason.isNull()).alias("accepted")
    return judged.observe(name, good, *[F.count_if(reason == r).alias(r) for r in ("late", "future")])


class BatchCounts(StreamingQueryListener):
    """The observed counts of the last micro-batches, by counter name and batch number."""

    def __init__(self, kept: int = 1000):
        self._kept = kept
        self._lock = threading.Lock()
        self._counts: dict[str, dict[int, dict[str, int]]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for name, row in progress.observedMetrics.items():
                batches = self._counts.setdefault(name, {})
                batches[progress.batchId] = row.asDict()
                while len(batches) > self._kept:
                    del batches[min(batches)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, name: str) -> dict[int, dict[str, int]]:
        """Counts per batch of one counter."""
        with self._lock:
            return {batch: dict(row) for batch, row in self._counts.get(name, {}).items()}
