"""Operators with keyed state and timers: what Spark's windowed aggregations cannot tell or keep.

All of them know the watermark of the batch and get the rows behind it too. Spark drops late rows of a stateful operator
only where the column that carries the watermark reaches it; here plain numbers do (``at``, ``window``, microseconds), so
timers run by the watermark and no row is lost.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatterloom.operators.decode import decode
from chatterloom.schemas import RAW_EVENT

_MILLI = 1000  # microseconds
#: Rows that need no state of their window are spread over so many keys.
SPREAD = 64
#: Up to so many rows of a window in one batch of a task stay under one key: each key costs calls for its state.
FEW_ROWS = 64


def _window_of(at: Column, seconds: int) -> Column:
    """Start of the tumbling window, in microseconds; null for no time."""
    width = F.lit(seconds * 1_000_000)
    return at - F.pmod(at, width)


def _timed(log: DataFrame, seconds: int, grace: str) -> DataFrame:
    """``payload``, ``event_id``, ``at`` and ``window`` of every message, under a watermark on their times."""
    decoded = decode(log, RAW_EVENT, ["event_id", "timestamp"], keep=["payload"])
    timed = decoded.select("payload", "data.event_id", "data.timestamp").withWatermark("timestamp", grace)
    at = F.unix_micros("timestamp")
    return timed.select("payload", "event_id", at.alias("at"), _window_of(at, seconds).alias("window"))


def _spread_of(payload: Column, keys: int) -> Column:
    return F.pmod(F.xxhash64(payload), F.lit(keys)).cast("int")


# Windows of a bounded number of events


class _Cap(StatefulProcessor):
    """Admits events of a window until it is full; its state goes when the watermark passes the window."""

    def __init__(self, per_window: int, seconds: int):
        self._per_window, self._width = per_window, seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._admitted = handle.getMapState("admitted", "event_id string", "at bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        window, spread = key
        end = None if window is None else (window + self._width) // _MILLI
        if end is None or spread:
            for row in rows:
                yield Row(payload=row.payload, verdict="unkeyed" if end is None or row.event_id is None else "over")
            return
        if end <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield Row(payload=row.payload, verdict="late")
            return
        known = {k[0] for k in self._admitted.keys()} if self._admitted.exists() else set()
        free = self._per_window - len(known)
        best: list[tuple[int, str]] = []  # the largest on top: times are negated, ids by _Down
        copies: dict[str, list[str]] = {}
        for row in rows:
            if row.event_id in known:  # delivered again: the table ignores it
                yield Row(payload=row.payload, verdict="kept")
            elif row.event_id in copies:
                copies[row.event_id].append(row.payload)
            elif free <= 0:
                yield Row(payload=row.payload, verdict="over")
            else:
                heapq.heappush(best, (-row.at, _Down(row.event_id)))
                copies[row.event_id] = [row.payload]
                if len(best) > free:
                    _, out = heapq.heappop(best)
                    for payload in copies.pop(out.text):
                        yield Row(payload=payload, verdict="over")
        if best and not known:
            self._handle.registerTimer(end)
        for at, name in best:
            self._admitted.updateValue((name.text,), (-at,))
            for payload in copies[name.text]:
                yield Row(payload=payload, verdict="kept")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._admitted.clear()
        return iter(())

    def close(self) -> None:
        pass


class _Down:
    """A text whose order is reversed."""

    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text

    def __lt__(self, other: _Down) -> bool:
        return self.text > other.text

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Down) and self.text == other.text


def _thin(per_window: int):
    """Marks, within a task, rows that so many others of their window come before: they cannot be admitted."""
    order = ["window", "at", "event_id"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = pd.DataFrame(columns=order)
        for batch in batches:
            keyed = batch.dropna(subset=["window", "event_id"])[order]
            seen = keyed if first.empty else pd.concat([first, keyed])
            seen = seen.drop_duplicates().sort_values(order)
            first = seen[seen.groupby("window").cumcount() < per_window]
            marked = batch.merge(first.assign(_in=True), how="left", on=order)
            contender = marked["_in"].notna().to_numpy()
            yield batch.assign(spread=batch["spread"].where(~contender, 0))

    return work


def capped(log: DataFrame, per_window: int, *, window_seconds: int = 60, grace: str = "30 seconds") -> DataFrame:
    """``payload`` and ``verdict`` of every message of a stream: each window takes ``per_window`` events.

    ``kept``: among the first of its window by (timestamp, event_id) when its batch came, and the window had room.
    ``over``: the window was full. ``late``: the window was over already. ``unkeyed``: no event id or time.

    The state of a window holds the ids it took, at most ``per_window``, so that an event that is delivered again does
    not count twice, and is cleared by a timer. Before the shuffle, each task sets apart what cannot be among the first;
    that is spread over many keys, so a window that holds a third of a batch is no single task's.
    """
    timed = _timed(log, window_seconds, grace)
    marked = timed.withColumn("spread", 1 + _spread_of(F.col("payload"), SPREAD))
    schema = "payload string, event_id string, at bigint, window bigint, spread int"
    thinned = marked.mapInPandas(_thin(per_window), schema)
    keyless = F.col("window").isNull() | F.col("event_id").isNull()
    thinned = thinned.withColumn("window", F.when(~keyless, F.col("window")))
    return thinned.groupBy("window", "spread").transformWithState(
        _Cap(per_window, window_seconds), "payload string, verdict string", "Append", "EventTime"
    )


# Counts that keep what came too late


class _Count(StatefulProcessor):
    """Counts a window's rows until the watermark passes its end, then gives back the rows that still come."""

    def __init__(self, seconds: int):
        self._width = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        window = key[0]
        end = None if window is None else (window + self._width) // _MILLI
        if end is None or end <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield Row(window=window, n=None, payload=row.payload)
            return
        new, before = sum(1 for _ in rows), self._count.get()
        self._count.update((new + (before[0] if before else 0),))
        if not before:
            self._handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(window=key[0], n=self._count.get()[0], payload=None)
        self._count.clear()

    def close(self) -> None:
        pass


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves only dense windows, and rows without a time, spread; the others get key 0."""
    for batch in batches:
        at = batch.schema.get_field_index("spread")
        window = batch.column("window")
        timed = np.asarray(window.is_valid())
        _, place, sizes = np.unique(window.fill_null(0).to_numpy(), return_inverse=True, return_counts=True)
        sparse = timed & (sizes[place] <= FEW_ROWS)
        spread = np.where(sparse, 0, batch.column(at).to_numpy()).astype("int32")
        yield batch.set_column(at, "spread", pa.array(spread))


def counted(log: DataFrame, *, window_seconds: int = 60, grace: str = "30 seconds", spread: int = 16) -> DataFrame:
    """Events per tumbling window once it is over, and every message that came after that or has no time.

    Rows with ``n`` are shares of a window's count, all in one batch: a dense window's rows are spread over ``spread``
    keys. Which key counts a row makes no difference to the sum.
    Rows with a ``payload`` are messages: behind the watermark, or, without a ``window``, without a time.
    """
    timed = _timed(log, window_seconds, grace).select("window", "payload", _spread_of(F.col("payload"), spread).alias("spread"))
    gathered = timed.mapInArrow(_gathered, "window bigint, payload string, spread int")
    return gathered.groupBy("window", "spread").transformWithState(
        _Count(window_seconds), "window bigint, n bigint, payload string", "Append", "EventTime"
    )


# Retries


class _Retry(StatefulProcessor):
    """Holds a failed event until its pause is over and counts how often it was let go."""

    def __init__(self, attempts: int, pause: float, forget: float):
        self._attempts, self._pause, self._forget = attempts, int(pause * 1000), int(forget * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._tried = handle.getValueState("tried", "n int, until bigint")
        self._held = handle.getValueState("held", "payload string, until bigint")

    def _release(self, payload: str, now: int) -> Row:
        before = self._tried.get()
        tried = before[0] + 1 if before else 1
        last = tried >= self._attempts
        if last:
            if before:
                self._tried.clear()
        else:
            until = now + self._forget
            self._tried.update((tried, until))
            if self._pause:
                self._handle.registerTimer(until)
        return Row(payload=payload, attempt=tried, last=last)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        payload = None
        for row in rows:  # copies of one event wait as one
            payload = row.payload if payload is None else max(payload, row.payload)
        if self._held.exists():
            return
        if not self._pause:
            yield self._release(payload, 0)
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        tried = self._tried.get()[0] if self._tried.exists() else 0
        until = now + self._pause * 2**tried
        self._held.update((payload, until))
        self._handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self._held.exists():
            payload, until = self._held.get()
            if until <= now:
                self._held.clear()
                yield self._release(payload, timerValues.getCurrentProcessingTimeInMs())
        elif self._tried.exists() and self._tried.get()[1] <= now:
            self._tried.clear()

    def close(self) -> None:
        pass


def due_again(failed: DataFrame, attempts: int, pause: float, forget: float = 86_400.0) -> DataFrame:
    """``payload``, ``attempt`` (from 1) and whether it is the ``last`` of failed events, each after its pause.

    The pause (seconds, 0 for none) doubles with every attempt of an event. ``failed`` has ``event_id`` and ``payload``.
    An event that does not come back within ``forget`` seconds, longer than any pause, has its attempts forgotten. Timers
    of the clock keep a query going, so a query that drains its log and ends has to do without a pause, and forgets none.
    """
    if pause * 2 ** max(attempts - 1, 0) >= forget:
        raise ValueError("attempts would be forgotten before the last pause is over")
    return failed.groupBy("event_id").transformWithState(
        _Retry(attempts, pause, forget), "payload string, attempt int, last boolean", "Append", "ProcessingTime" if pause else "None"
    )
