"""Looking at and stopping streaming queries."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def describe(query: StreamingQuery) -> dict:
    """Identity and state of one query."""
    return {
        "id": query.id,
        "name": query.name,
        "active": query.isActive,
        "status": query.status,
        "last_progress": query.lastProgress,
    }


def row_checks(frame: DataFrame, **conditions: Column) -> list[Column]:
    """Counts to observe: all rows, the nulls of each column, and the rows that meet each condition."""
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in frame.columns],
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
    ]


def checked(frame: DataFrame, name: str | Observation, **conditions: Column) -> DataFrame:
    """The frame, batch or stream, whose ``row_checks`` are counted in the pass that writes it.

    A stream reports them with each batch (``ProgressTotals`` adds them up). For a
    batch frame pass an ``Observation`` as the name.
    """
    return frame.observe(name, *row_checks(frame, **conditions))


@dataclass
class Totals:
    """What a run has read, and dropped behind the watermark, over all its batches.

    A windowed aggregate combines rows before they reach its state, so for one
    the dropped rows are combined rows.
    """

    batches: int = 0
    rows_read: int = 0
    rows_dropped_late: int = 0
    # Sums of the observed metrics, by the name they were observed under.
    observed: dict[str, dict[str, int]] = field(default_factory=dict)


class ProgressTotals(StreamingQueryListener):
    """Adds up the progress reports of each run; a query keeps the latest ones only."""

    def __init__(self) -> None:
        self._totals: dict[str, Totals] = defaultdict(Totals)
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._news:
            totals = self._totals[str(progress.runId)]
            totals.batches += 1
            totals.rows_read += progress.numInputRows
            totals.rows_dropped_late += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            for name, row in (progress.observedMetrics or {}).items():
                sums = totals.observed.setdefault(name, {})
                for metric, value in row.asDict().items():
                    sums[metric] = sums.get(metric, 0) + (value or 0)

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def of(self, query: StreamingQuery, seconds: float = 60) -> Totals:
        """Totals of a run that has ended; its last reports may take a moment to come."""
        run = str(query.runId)
        with self._news:
            if not self._news.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"no report of the end of {query.name or query.id} in {seconds} s")
            return self._totals[run]


@contextmanager
def progress_totals(spark: SparkSession) -> Iterator[ProgressTotals]:
    """Totals of the queries that are started inside the ``with`` block."""
    listener = ProgressTotals()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def find(spark: SparkSession, name: str) -> StreamingQuery | None:
    """Active query of that name."""
    return next((q for q in spark.streams.active if q.name == name), None)


def stop_all(spark: SparkSession, seconds: int = 60) -> None:
    """Stop every active query and wait for each; fail if one goes on."""
    for query in spark.streams.active:
        query.stop()
        if not query.awaitTermination(seconds):
            raise TimeoutError(f"streaming query {query.name or query.id} did not stop in {seconds} s")
