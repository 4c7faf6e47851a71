"""Counts of words and topics in sliding event-time windows.

The operators run on batches and on streams; a stream emits a window once its
watermark has passed the window's end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterloom.functions.text import STOP_WORDS, clean_topic, is_trend_word, words
from chatterloom.operators.ranking import first_per_group

WINDOW = "30 seconds"
SLIDE = "15 seconds"
WATERMARK = "30 seconds"

TUMBLING_WINDOW = "60 seconds"
TUMBLING_GRACE = "30 seconds"


def per_window(
    rows: DataFrame,
    keys: Sequence[str] = (),
    *,
    size: str,
    every: str | None = None,
    grace: str | None = None,
    time: str = "timestamp",
    into: str = "count",
) -> DataFrame:
    """Rows in each window of ``size`` (one beginning ``every`` so often) and key.

    ``grace`` sets how late rows of a stream may come; without it, a watermark
    that the rows already have applies.
    """
    if grace is not None:
        rows = rows.withWatermark(time, grace)
    slot = F.window(time, size, every)
    counts = rows.groupBy(slot.alias("slot"), *keys).agg(F.count(F.lit(1)).alias(into))
    bounds = [F.col(f"slot.{edge}").alias(f"window_{edge}") for edge in ("start", "end")]
    return counts.select(*bounds, *keys, into)


#: So many windows that begin one after the other are counted as one row per key.
_BLOCK = 4
_PLACE = ("_block", "_pane")


def _micros(length: str) -> int | None:
    """A plain length of time in microseconds; None for one that only Spark can read."""
    try:
        return int(pd.Timedelta(length).value // 1000)
    except ValueError:
        return None


@dataclass(frozen=True)
class _Panes:
    """Sliding windows as runs of ``run`` panes, each ``step`` microseconds long; ``_BLOCK`` windows make a block.

    A row is in one pane, whatever the number of windows it is in, and the panes of a block are columns of one row per
    key: a key that comes again in a block is shuffled once. The first panes of a block end windows of the block before,
    so rows in them are placed there, too.
    """

    step: int
    run: int

    @classmethod
    def of(cls, rows: DataFrame, size: str, every: str | None, time: str = "timestamp") -> _Panes | None:
        """None where panes do not apply: on streams, whose windows close one by one, and for uneven windows."""
        width, step = _micros(size), _micros(every or size)
        if rows.isStreaming or dict(rows.dtypes)[time] != "timestamp" or not width or not step or width % step:
            return None
        return cls(step, width // step) if width // step <= _BLOCK else None

    def place(self, rows: DataFrame, time: str = "timestamp") -> DataFrame:
        """Rows that have a time, with the ``_block`` (its first microsecond) and the ``_pane`` in it."""
        span = self.step * _BLOCK
        at = F.unix_micros(time)
        block = at - F.pmod(at, F.lit(span))
        pane = F.floor(F.pmod(at, F.lit(span)) / self.step).cast("int")
        here = F.struct(block.alias("_block"), pane.alias("_pane"))
        before = F.struct((block - span).alias("_block"), (pane + _BLOCK).alias("_pane"))
        places = F.when(pane < self.run - 1, F.array(here, before)).otherwise(F.array(here))
        return rows.filter(F.col(time).isNotNull()).select("*", F.inline(places))

    def count(self, placed: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
        panes = [f"_n{n}" for n in range(_BLOCK + self.run - 1)]
        inside = [F.count(F.when(F.col("_pane") == n, 1)).alias(name) for n, name in enumerate(panes)]
        blocks = placed.groupBy("_block", *keys).agg(*inside)
        windows = []
        for n in range(_BLOCK):
            start = F.col("_block") + n * self.step
            total = reduce(add, [F.col(name) for name in panes[n : n + self.run]])
            end = start + self.run * self.step
            edges = [F.timestamp_micros(x).alias(f"window_{name}") for name, x in (("start", start), ("end", end))]
            windows.append(F.struct(*edges, total.alias(into)))
        found = blocks.select(*keys, F.inline(F.array(*windows))).filter(F.col(into) > 0)
        return found.select("window_start", "window_end", *keys, into)


def trend_words(
    events: DataFrame, stop_words: tuple[str, ...] = STOP_WORDS, *, keep: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """(timestamp, word) of every counted word; ``keep`` names other columns to stay."""
    spoken = events.select(*keep, F.explode(words(F.col("title"), F.col("content"))).alias("word"))
    return spoken.filter(is_trend_word(F.col("word"), stop_words))


def trend_topics(events: DataFrame, *, keep: Sequence[str] = ("timestamp",)) -> DataFrame:
    """(timestamp, topic) of every named topic, cleaned, blanks dropped; ``keep`` names other columns to stay."""
    named = events.select(*keep, F.explode("topics").alias("topic"))
    return named.withColumn("topic", clean_topic(F.col("topic"))).filter(F.col("topic") != "")


def trending_words(
    events: DataFrame,
    stop_words: tuple[str, ...] = STOP_WORDS,
    *,
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    panes = _Panes.of(events, window, slide)
    if panes is not None:
        spoken = trend_words(panes.place(events), stop_words, keep=_PLACE)
        return panes.count(spoken, ["word"], "count")
    spoken = trend_words(events, stop_words)
    return per_window(spoken, ["word"], size=window, every=slide, grace=watermark)


def texts_per_window(
    events: DataFrame,
    stop_words: tuple[str, ...] = STOP_WORDS,
    *,
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """The first half of ``trending_words`` for streams: how often (``texts``) each text comes in each window.

    ``text`` is the counted words of an event. A stream keeps a row of state for each text of a window, not for each word,
    of which texts have hundreds; ``words_of_texts`` counts them when the window is over. Equal texts are one row, and
    different ones are dealt by themselves, so that no window is in one task.
    """
    spoken = F.filter(words(F.col("title"), F.col("content")), lambda word: is_trend_word(word, stop_words))
    # As a generator, which splits a text once; no word holds a space.
    texts = events.select("timestamp", F.explode(F.array(F.array_join(spoken, " "))).alias("text"))
    return per_window(texts.filter(F.col("text") != ""), ["text"], size=window, every=slide, grace=watermark, into="texts")


def words_of_texts(texts: DataFrame) -> DataFrame:
    """The second half: counts of the words in whole windows of ``texts_per_window``, in a batch."""
    bounds = ["window_start", "window_end"]
    spoken = texts.select(*bounds, "texts", F.explode(F.split("text", " ")).alias("word"))
    return spoken.groupBy(*bounds, "word").agg(F.sum("texts").alias("count"))


def trending_topics(
    events: DataFrame,
    *,
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    panes = _Panes.of(events, window, slide)
    if panes is not None:
        return panes.count(trend_topics(panes.place(events), keep=_PLACE), ["topic"], "count")
    return per_window(trend_topics(events), ["topic"], size=window, every=slide, grace=watermark)


def drop_redelivered(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Drops redelivered events of a stream before they are counted.

    Its watermark stays in force: count with ``watermark=None`` afterwards.
    """
    return events.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"])


def tumbling_counts(
    events: DataFrame, *, window: str = TUMBLING_WINDOW, grace: str | None = TUMBLING_GRACE
) -> DataFrame:
    """Events per tumbling window."""
    return per_window(events, size=window, grace=grace)


def _window_start(window: str) -> Column:
    return F.window("timestamp", window)["start"]


def first_per_window(events: DataFrame, n: int, *, window: str = TUMBLING_WINDOW) -> DataFrame:
    """The first ``n`` events of every tumbling window by (timestamp, event_id)."""
    order = [F.asc("timestamp"), F.asc("event_id")]
    started = events.withColumn("window_start", _window_start(window))
    return first_per_group(started, ["window_start"], order, n)


def mark_over_cap(events: DataFrame, n: int, *, window: str = TUMBLING_WINDOW) -> DataFrame:
    """All events with their ``window_start`` and whether ``n`` others come before (``over_cap``).

    Only the first ``n`` events of a window are ever sorted in one task; the
    others are compared with the last of them. Events that repeat its time and
    id stay with it.
    """
    position = F.struct("timestamp", "event_id")
    last = (
        first_per_window(events, n, window=window)
        .groupBy("window_start")
        .agg(F.max(position).alias("_last"))
    )
    started = events.withColumn("window_start", _window_start(window))
    over = F.coalesce(position > F.col("_last"), F.lit(n <= 0))
    return started.join(last, "window_start", "left").withColumn("over_cap", over).drop("_last")


def within_cap(
    events: DataFrame, admitted: DataFrame, n: int, *, window: str = TUMBLING_WINDOW
) -> DataFrame:
    """The events that still fit when a window takes ``n`` and holds ``admitted``.

    At most ``n`` events per window remain to be numbered after the first step.
    What does not fit is the caller's to keep (``save_raw_capped`` writes it).
    """
    candidates = first_per_window(events, n, window=window)
    start = _window_start(window).alias("window_start")
    taken = admitted.groupBy(start).agg(F.count("*").alias("_taken"))
    order = Window.partitionBy("window_start").orderBy("timestamp", "event_id")
    place = F.row_number().over(order) + F.coalesce("_taken", F.lit(0))
    return (
        candidates.join(taken, "window_start", "left")
        .withColumn("_place", place)
        .filter(F.col("_place") <= n)
        .drop("window_start", "_taken", "_place")
    )
