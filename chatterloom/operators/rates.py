"""Event rates over time, as dashboards show them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.operators.trending import per_window

_MINUTE = 60


def event_rate(events: DataFrame, stream: str = "stream", time: str = "timestamp") -> DataFrame:
    """Events per stream and minute; minutes without events have no row."""
    counted = per_window(events, [stream], size="1 minute", time=time, into="events")
    return counted.select(stream, F.col("window_start").alias("minute_start"), "events")


def latest_rate(rates: DataFrame, stream: str = "stream") -> DataFrame:
    """The newest minute of every stream and its rate."""
    return rates.groupBy(stream).agg(
        F.max("minute_start").alias("minute_start"),
        F.max_by("events", "minute_start").alias("events"),
    )


def rolling_average(rates: DataFrame, stream: str = "stream", minutes: int = 5) -> DataFrame:
    """Mean rate of each minute and the ``minutes - 1`` before it.

    Every minute adds its rate to the averages it takes part in, so no task
    sorts a whole stream. Only minutes that have a row count, and only they
    get an average.
    """
    ahead = F.explode(F.sequence(F.lit(0), F.lit(minutes - 1))).alias("ahead")
    shares = rates.select(stream, "minute_start", "events", ahead)
    target = F.timestamp_seconds(
        F.unix_timestamp("minute_start") + F.col("ahead") * _MINUTE
    )
    averages = shares.groupBy(stream, target.alias("minute_start")).agg(
        F.avg("events").alias("rolling_avg"), F.min("ahead").alias("nearest")
    )
    return averages.filter(F.col("nearest") == 0).drop("nearest")


def live_rates(
    events: DataFrame,
    stream: str = "stream",
    time: str = "timestamp",
    *,
    minutes: int = 5,
    grace: str | None = "30 seconds",
) -> DataFrame:
    """``event_rate`` and ``rolling_average`` in one pass that runs on a stream, too.

    Events are counted by minute, and these counts by the windows of ``minutes`` that begin every minute; a row comes
    out when the window that its minute ends is over. Both states hold what the watermark has not passed.
    """
    if grace is not None:
        events = events.withWatermark(time, grace)
    counts = events.groupBy(F.window(time, "1 minute").alias("slot"), stream).agg(F.count(F.lit(1)).alias("events"))
    span = F.window(F.window_time("slot"), f"{minutes} minutes", "1 minute").alias("span")
    newest = F.max("slot.start").alias("minute_start")
    averages = counts.groupBy(span, stream).agg(
        newest, F.max_by("events", "slot.start").alias("events"), F.avg("events").alias("rolling_avg")
    )
    last = F.col("span.end") - F.make_dt_interval(mins=F.lit(1))
    return averages.filter(F.col("minute_start") == last).select(stream, "minute_start", "events", "rolling_avg")


def media_counts(events: DataFrame, group: str) -> DataFrame:
    """Events and events with media per group."""
    return events.groupBy(group).agg(
        F.count("*").alias("events"),
        F.count_if("has_media").alias("with_media"),
    )


def outcome_counts(outcomes: DataFrame, *groups: str) -> DataFrame:
    """Rows per ``status`` (and group): sent or failed, enriched or not."""
    return outcomes.groupBy(*groups, "status").agg(F.count("*").alias("events"))
