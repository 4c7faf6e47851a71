"""The daily batch jobs over the event lake."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.functions.time import chunk_bounds
from chatterloom.operators.dedup import dedup_latest
from chatterloom.operators.ranking import top_posts
from chatterloom.operators.rates import event_rate, rolling_average
from chatterloom.operators.sentiment import (
    sentiment_by_group,
    sentiment_by_topic,
    weekly_topics,
)
from chatterloom.schemas import TABLES, require_columns
from chatterloom.session import stored
from chatterloom.sinks.tables import CHUNK_DAYS, read_table, replace_table
from chatterloom.sources.lake import read_lake


# Decides between copies of an event, the same way in every job.
_NEWEST_FIRST = ("timestamp", "score", "enrichment_sentiment")


def unique_events(events: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The latest copy of every event, with just the given columns."""
    columns = list(columns)
    needed = list(dict.fromkeys((*columns, *_NEWEST_FIRST)))
    rows = require_columns(events, needed).select(*needed)
    return dedup_latest(rows, newest_first=_NEWEST_FIRST).select(*columns)


@dataclass(frozen=True)
class BatchJob:
    """A result table, the lake columns it needs and how it is computed."""

    table: str
    columns: tuple[str, ...]
    compute: Callable[[DataFrame], DataFrame]

    def result(self, events: DataFrame) -> DataFrame:
        """The job's rows from lake events that may hold copies."""
        return self.compute(unique_events(events, self.columns))


_SENTIMENT = ("event_id", "timestamp", "score", "enrichment_sentiment", "posted_in_subreddit")

# In the order of a daily run; weekly topics are due on Sundays.
JOBS = {
    "daily_sentiment": BatchJob(
        "batch_daily_sentiment", _SENTIMENT, lambda e: sentiment_by_group(e, "day")
    ),
    "hourly_sentiment": BatchJob(
        "batch_hourly_sentiment", _SENTIMENT, lambda e: sentiment_by_group(e, "hour")
    ),
    "topic_sentiment": BatchJob(
        "batch_topic_sentiment",
        ("event_id", "timestamp", "enrichment_sentiment", "enrichment_topics"),
        sentiment_by_topic,
    ),
    "top_posts": BatchJob("batch_top_posts", (*_SENTIMENT, "title"), top_posts),
    "weekly_topics": BatchJob(
        "batch_weekly_topics", ("event_id", "timestamp", "enrichment_topics"), weekly_topics
    ),
}


# How far apart the copies of one event may be in time.
COPY_MARGIN = timedelta(days=1)


def run_job(spark: SparkSession, name: str, lake: str, output: str, **bounds: date | None) -> None:
    """Runs one job over the lake (or some days of it) into ``output/<table>``."""
    run_jobs(spark, lake, output, [name], **bounds)


def run_jobs(
    spark: SparkSession,
    lake: str,
    output: str,
    names: Iterable[str] = tuple(JOBS),
    *,
    since: date | None = None,
    until: date | None = None,
    margin: timedelta = COPY_MARGIN,
) -> None:
    """Runs jobs over the lake, or some days of it, on one deduplicated copy.

    The copy is a table in the shared scratch folder: deduplication shuffles
    the lake once instead of once per job, and a lost executor costs a re-read
    instead of a recomputation.

    Bounds are widened to whole chunks of the result tables, and only those
    chunks are replaced. Events up to ``margin`` outside take part in the
    deduplication, so an event whose copies lie on both sides of a bound is
    counted where its latest copy is, as in a run over everything.
    """
    jobs = [JOBS[name] for name in names]
    columns = dict.fromkeys(c for job in jobs for c in job.columns)
    since, until = chunk_bounds(since, until, CHUNK_DAYS)
    near = read_lake(
        spark, lake, since=since and since - margin, until=until and until + margin
    )
    unique = unique_events(near, columns)
    if since is not None:
        unique = unique.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))
    if until is not None:
        unique = unique.filter(F.col("timestamp") < F.lit(until).cast("timestamp"))
    whole = since is None and until is None
    with stored(unique, "deduplicated") as events:
        for job in jobs:
            rows = job.compute(events.select(*job.columns))
            path = f"{output}/{job.table}"
            replace_table(rows, TABLES[job.table], path, whole=whole, span=(since, until))


def run_rates(spark: SparkSession, tables: str, output: str) -> None:
    """Event rates of the stored raw and enriched events, per minute and over five minutes."""
    streams = ("raw_events", "enriched_events")
    times = None
    for name in streams:
        rows = read_table(spark, TABLES[name], f"{tables}/{name}")
        one = rows.select("timestamp", F.lit(name).alias("stream"))
        times = one if times is None else times.unionByName(one)
    rates = event_rate(times)
    averages = rolling_average(rates)
    both = rates.join(averages, ["stream", "minute_start"])
    replace_table(both, TABLES["event_rates"], f"{output}/event_rates")
