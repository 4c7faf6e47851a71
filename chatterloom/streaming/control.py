"""Starting, bounding, listing and stopping streaming queries."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

POLL_SECONDS = 120
_LOOK_SECONDS = 1.0


def trigger(*, once: bool = False, seconds: int = POLL_SECONDS) -> dict:
    """Trigger arguments: drain what is there and stop, or poll forever."""
    return {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}


def checkpoint_path(base: str, table: str, job: str) -> str:
    """Checkpoint of one job writing one table, whatever its source."""
    return f"{base.rstrip('/')}/{table}/{job}"


def run_for(query: StreamingQuery, max_seconds: float | None = None) -> bool:
    """Waits for the query, at most ``max_seconds``, then stops it.

    Returns whether the query had ended by itself. Its failure is raised.
    """
    if max_seconds is None:
        query.awaitTermination()
        return True
    ended = query.awaitTermination(max_seconds)
    if not ended:
        query.stop()
    return bool(ended)


def run_together(queries: Sequence[StreamingQuery], max_seconds: float | None = None) -> bool:
    """Waits for all queries of a job at once, at most ``max_seconds`` in all, then stops those that still run.

    A failure of any stops the others and is raised. Returns whether all had ended by themselves.
    """
    end = None if max_seconds is None else time.monotonic() + max_seconds
    running = list(queries)
    try:
        while running and (end is None or time.monotonic() < end):
            wait = _LOOK_SECONDS if end is None else min(_LOOK_SECONDS, max(end - time.monotonic(), 0.01))
            # Raises the failure of a query that has ended.
            running = [q for n, q in enumerate(running) if not q.awaitTermination(wait if n == 0 else 0.01)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    return not running


def active_queries(spark: SparkSession) -> list[tuple[str, str]]:
    """(id, name) of every running query."""
    return [(str(q.id), q.name or "") for q in spark.streams.active]


def stop_all(spark: SparkSession) -> int:
    """Stops every running query and returns how many there were."""
    running = spark.streams.active
    for query in running:
        query.stop()
    return len(running)


class LateRows(StreamingQueryListener):
    """Counts the rows that windows refused as too late, per query, over its whole run.

    ``recentProgress`` forgets; a listener hears every batch. Register it with
    ``watch_late_rows`` before the query starts.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        refused = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.dropped[str(progress.id)] = self.dropped.get(str(progress.id), 0) + refused

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watch_late_rows(spark: SparkSession) -> LateRows:
    counter = LateRows()
    spark.streams.addListener(counter)
    return counter


def late_rows_dropped(query: StreamingQuery, counter: LateRows) -> int:
    """What ``counter`` heard of the query once it has ended."""
    bus = query._jsq.sparkSession().sparkContext().listenerBus()
    bus.waitUntilEmpty(30_000)
    return counter.dropped.get(str(query.id), 0)
