"""One query per operator (or closely tied group of operators)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import partial
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.functions.media import media_urls
from chatterloom.functions.text import prompt_text
from chatterloom.operators import cursor, enrich, rates
from chatterloom.operators.decode import decode, decode_tolerant
from chatterloom.operators.dedup import dedup_latest, dedup_report
from chatterloom.operators.flatten import flatten_enriched, flatten_raw, to_lake_rows, to_messages
from chatterloom.operators.merge import new_rows
from chatterloom.operators.normalize import to_events
from chatterloom.operators.ranking import newest_per_group
from chatterloom.operators.retention import retain
from chatterloom.operators.trending import (
    mark_over_cap,
    trending_topics,
    trending_words,
    tumbling_counts,
)
from chatterloom.operators.validate import split_valid, with_quality_flags
from chatterloom.plans import incremental
from chatterloom.plans.batch import JOBS, run_job, run_jobs, run_rates
from chatterloom.schemas import ENRICHED_EVENT, LAKE_EVENT, LISTING_PAGE, RAW_EVENT, TABLES, ddl
from chatterloom.session import SETTINGS, scratch_path
from chatterloom.sinks.lake import compact_lake, write_lake
from chatterloom.sinks.logs import publish
from chatterloom.sinks.tables import append_table, insert_ignore, read_table, replace_table
from chatterloom.sources.lake import read_lake
from chatterloom.sources.listings import items, read_listings, split_items
from chatterloom.sources.logs import read_log
from chatterloom.streaming import queries as streams
from chatterloom.streaming.control import late_rows_dropped, run_for, trigger, watch_late_rows
from workload import frames
from workload.providers import LengthProvider, OddProvider, StepProvider

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_DRAIN = trigger(once=True)
#: What results depend on, and what keyed state runs on, in a session built elsewhere.
_NEEDED = ("spark.sql.session.timeZone", *[key for key in SETTINGS if ".stateStore." in key])


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key in _NEEDED:
            spark.conf.set(key, SETTINGS[key])
        return frames.plain(function(spark, sf_dir))

    _QUERIES[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Batch jobs


def _job(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = JOBS[name].result(frames.lake_events_with_copies(spark, sf_dir))
        return TABLES[JOBS[name].table].conform(result)

    run.__name__ = name
    return _query(run)


def _rounded(query: Query) -> Query:
    """The spread is the one measure whose last digits depend on row order."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir).withColumn("sentiment_stddev", F.round("sentiment_stddev", 6))

    run.__name__ = query.__name__
    return _query(run)


daily_sentiment = _rounded(_job("daily_sentiment"))
hourly_sentiment = _rounded(_job("hourly_sentiment"))
topic_sentiment = _job("topic_sentiment")
top_posts = _job("top_posts")
weekly_topics = _job("weekly_topics")


def _stored_lake(spark: SparkSession, sf_dir: str) -> str:
    lake = scratch_path(spark, "lake")
    events = frames.lake_events_with_copies(spark, sf_dir)
    missing = [F.lit(None).cast(t).alias(n) for n, t in LAKE_EVENT.items() if n not in events.columns]
    write_lake(events.select("*", *missing), lake)
    return lake


def _job_table(spark: SparkSession, output: str, name: str) -> DataFrame:
    table = JOBS[name].table
    stored = read_table(spark, TABLES[table], f"{output}/{table}").drop("chunk_start")
    if "sentiment_stddev" in stored.columns:
        stored = stored.withColumn("sentiment_stddev", F.round("sentiment_stddev", 6))
    return stored


def _suite(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All five jobs from a lake to tables; one table is read back."""
        output = scratch_path(spark, "tables")
        run_jobs(spark, _stored_lake(spark, sf_dir), output)
        return _job_table(spark, output, name)

    run.__name__ = f"job_suite_{name.replace('_sentiment', '')}"
    return _query(run)


for _name in JOBS:
    _suite(_name)


@_query
def daily_sentiment_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weeks one by one, over events whose copies lie on both sides of midnight."""
    lake, output = _stored_lake(spark, sf_dir), scratch_path(spark, "tables")
    first, last = frames.lake_events_with_copies(spark, sf_dir).agg(
        F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))
    ).first()
    since = first
    while since <= last:
        until = since + timedelta(days=7 - since.weekday())
        run_job(spark, "daily_sentiment", lake, output, since=since, until=until)
        since = until
    return _job_table(spark, output, "daily_sentiment")


def _taken_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """All events in three parts; many a copy comes in another part than its event, before or after it."""
    root, events = scratch_path(spark, "state"), frames.lake_events_with_copies(spark, sf_dir)
    for number in range(3):
        incremental.update(spark, root, events.filter(F.pmod("score", F.lit(3)) == number))
    return root


def _incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sentiment from states that three parts have updated."""
    return incremental.daily_sentiment(spark, _taken_in_parts(spark, sf_dir))


_incremental_daily.__name__ = "daily_sentiment_incremental"
daily_sentiment_incremental = _rounded(_incremental_daily)


@_query
def weekly_topics_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly topics likewise."""
    return incremental.weekly_topics(spark, _taken_in_parts(spark, sf_dir))


@_query
def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(frames.lake_events_with_copies(spark, sf_dir))


@_query
def dedup_report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(frames.lake_events_with_copies(spark, sf_dir))


# Trending, as batches and as streams


@_query
def trending_words_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending_words(frames.documents(spark, sf_dir))


@_query
def trending_topics_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending_topics(frames.stream_events(spark, sf_dir))


@_query
def trending_words_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window the operators document as an alternative: 10 by 5 minutes."""
    return trending_words(frames.documents(spark, sf_dir), window="10 minutes", slide="5 minutes")


SLICES, FILES = 3, 4
#: Messages in a file of a log; a slice has more than ``FILES`` files rather than longer ones.
FILE_ROWS = 100_000


def _files(rows: int) -> int:
    """Files of each slice of a log: what one task writes does not grow with the log."""
    return max(FILES, ceil(rows / (SLICES * FILE_ROWS)))


def _timed_log(
    spark: SparkSession, events: DataFrame, *, copies: int = 1, again: bool = False, end: DataFrame | None = None
) -> DataFrame:
    """Events as a JSON log that a stream reads in ``SLICES`` micro-batches, in time order.

    ``copies``: so often each event is delivered, in one micro-batch. ``again``: the first slice comes once more, as a
    batch behind the others. ``end``: events of one last file.
    """
    log_dir = scratch_path(spark, "log")
    seconds = F.unix_micros("timestamp") / 1e6
    low, high, rows = events.agg(F.min(seconds), F.max(seconds), F.count(F.lit(1))).first()
    files = _files(rows * copies)
    edges = [low + (high - low) * n / SLICES for n in range(SLICES)]
    slices = [*range(SLICES), *([0] if again else [])]
    for number in slices:
        part = events.filter(seconds >= edges[number])
        if number + 1 < SLICES:
            part = part.filter(seconds < edges[number + 1])
        # Encoded once, behind the shuffle, however often it is delivered.
        messages = to_messages(part.repartition(files)).select(F.explode(F.array_repeat("value", copies)).alias("value"))
        messages.write.mode("append").text(log_dir)
    if end is not None:
        publish(end.coalesce(1), log_dir, format="text")
    return read_log(spark, log_dir, format="text", batch_limit=files)


def _streamed(spark: SparkSession, events: DataFrame, start, table: str, copies: int = 1, **options) -> DataFrame:
    """Events -> JSON log -> stream -> result table, read back."""
    target, checkpoint = (scratch_path(spark, x) for x in (table, "checkpoint"))
    run_for(start(_timed_log(spark, events, copies=copies), target, checkpoint, trigger=_DRAIN, **options))
    return read_table(spark, TABLES[table], target).drop("chunk_start")


def _unusable(spark: SparkSession) -> dict[str, str]:
    return {"quarantine": scratch_path(spark, "quarantine")}


@_query
def trending_words_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.document_events(spark, sf_dir)
    return _streamed(spark, events, streams.save_trending_words, "trending_words_metrics")


@_query
def trending_topics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.enriched_events(spark, sf_dir)
    return _streamed(spark, events, streams.save_trending_topics, "trending_topics_metrics")


@_query
def trending_topics_unique_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice and counted once."""
    events = frames.enriched_events(spark, sf_dir)
    start = partial(streams.save_trending_topics, unique=True)
    return _streamed(spark, events, start, "trending_topics_metrics", copies=2)


@_query
def save_raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.raw_events(spark, sf_dir)
    return _streamed(spark, events, streams.save_raw, "raw_events", **_unusable(spark))


@_query
def window_cap_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three events an hour are stored, the others kept in the overflow."""
    events, overflow = frames.raw_events(spark, sf_dir), scratch_path(spark, "overflow")
    start = partial(streams.save_raw_capped, per_window=3, window_seconds=3600, overflow=overflow)
    kept = _streamed(spark, events, start, "raw_events", **_unusable(spark))
    over = decode(read_log(spark, overflow, format="text", streaming=False), RAW_EVENT)
    return kept.withColumn("over_cap", F.lit(False)).unionByName(
        flatten_raw(over).withColumn("over_cap", F.lit(True))
    )


@_query
def window_cap_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by counts in state, cleared when a window is over."""
    events, overflow = frames.raw_events(spark, sf_dir), scratch_path(spark, "overflow")
    start = partial(streams.save_raw_capped_by_state, per_window=3, window_seconds=3600, overflow=overflow)
    kept = _streamed(spark, events, start, "raw_events", **_unusable(spark))
    over = decode(read_log(spark, overflow, format="text", streaming=False), RAW_EVENT)
    return kept.withColumn("over_cap", F.lit(False)).unionByName(
        flatten_raw(over).withColumn("over_cap", F.lit(True))
    )


@_query
def tumbling_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.document_events(spark, sf_dir)
    return _streamed(spark, events, streams.save_tumbling_counts, "tumbling_counts_metrics")


@_query
def late_drop_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first third of the log comes again at its end: too late for every window."""
    log = _timed_log(spark, frames.document_events(spark, sf_dir), again=True)
    target, checkpoint = (scratch_path(spark, x) for x in ("counts", "checkpoint"))
    counter = watch_late_rows(spark)
    query = streams.save_tumbling_counts(log, target, checkpoint, trigger=_DRAIN)
    run_for(query)
    dropped = late_rows_dropped(query, counter)
    spark.streams.removeListener(counter)
    counts = read_table(spark, TABLES["tumbling_counts_metrics"], target).drop("chunk_start")
    # How many rows are refused depends on how they were counted before; that some are does not.
    return counts.withColumn("some_refused", F.lit(dropped > 0))


@_query
def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log; every event is in a count or, late, kept. A last event a day ahead closes all windows before it."""
    events = frames.document_events(spark, sf_dir)
    ahead = F.col("timestamp") + F.expr("interval 1 day")
    end = events.orderBy(F.desc("timestamp")).limit(1).withColumns({"timestamp": ahead, "event_id": F.lit("end")})
    log = _timed_log(spark, events, again=True, end=end)
    target, late, checkpoint = (scratch_path(spark, x) for x in ("counts", "late", "checkpoint"))
    heard: list[int] = []
    query = streams.save_counts_and_late(
        log, target, checkpoint, trigger=_DRAIN, late=late, **_unusable(spark),
        report=lambda counts: heard.append(counts["late"]),
    )
    run_for(query)
    counts = read_table(spark, TABLES["tumbling_counts_metrics"], target)
    behind = flatten_raw(decode(read_log(spark, late, format="text", streaming=False), RAW_EVENT))
    nothing = F.lit(None)
    total = spark.range(1).select(
        F.lit("late_total").alias("kind"), nothing.cast("timestamp").alias("time"), nothing.cast("string").alias("event_id"),
        F.lit(sum(heard)).cast("bigint").alias("count"),
    )
    return (
        counts.select(F.lit("counted").alias("kind"), F.col("window_start").alias("time"), nothing.cast("string").alias("event_id"), "count")
        .unionByName(behind.select(F.lit("late").alias("kind"), F.col("timestamp").alias("time"), "event_id", F.lit(1).cast("bigint").alias("count")))
        .unionByName(total)
    )


@_query
def live_rates_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and rolling averages per group, of all minutes the watermark has passed."""
    events = frames.raw_events(spark, sf_dir)
    start = partial(streams.save_live_rates, stream="posted_in_subreddit")
    return _streamed(spark, events, start, "event_rates")


@_query
def save_enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.enriched_events(spark, sf_dir)
    return _streamed(spark, events, streams.save_enriched, "enriched_events", **_unusable(spark))


@_query
def tumbling_counts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(frames.documents(spark, sf_dir))


@_query
def window_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.lake_events(spark, sf_dir).select("event_id", "timestamp")
    return mark_over_cap(events, 3, window="1 hour")


# Messages and layouts


@_query
def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(frames.raw_events(spark, sf_dir))
    return flatten_raw(decode(messages.select(F.col("value").alias("payload")), RAW_EVENT))


@_query
def enriched_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(frames.enriched_events(spark, sf_dir))
    return flatten_enriched(decode(messages.select(F.col("value").alias("payload")), ENRICHED_EVENT))


@_query
def lake_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_lake_rows(frames.enriched_events(spark, sf_dir))


@_query
def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by day, compacted into a second lake, read back."""
    lake, compacted = scratch_path(spark, "lake"), scratch_path(spark, "compacted")
    write_lake(to_lake_rows(frames.enriched_events(spark, sf_dir)), lake)
    compact_lake(spark, lake, compacted)
    return read_lake(spark, compacted)


@_query
def store_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, checkpoint = (scratch_path(spark, x) for x in ("lake", "checkpoint"))
    log = _timed_log(spark, frames.enriched_events(spark, sf_dir))
    run_for(streams.store_log(log, lake, checkpoint, trigger=_DRAIN))
    return read_lake(spark, lake)


def _doubtful_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as messages, many of them damaged in one of several ways."""
    k = F.col("k")
    text = F.col("k").cast("string")
    fields = {
        "event_id": F.when(k.between(10, 19), "").otherwise(F.col("event_id")),
        "event_type": F.when(k.between(20, 29), "LINK").otherwise("POST"),
        "posted_in_subreddit": F.col("event_type"),
        "author": F.lit("a"),
        "url": F.when(k.between(70, 74), F.lit(None).cast("string")).otherwise("u"),
        "timestamp": F.when(k.between(30, 39), "bad").otherwise(
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ),
        "score": F.when(k.between(50, 59), "abc").otherwise(text),
        "num_comments": F.when(k.between(60, 69), "3.0").otherwise(text),
    }
    message = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    payload = F.when(k < 10, F.concat(F.lit("not json "), "event_id")).otherwise(message)
    return frames.source_events(spark, sf_dir).select(payload.alias("payload"))


@_query
def validate_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = split_valid(decode_tolerant(_doubtful_payloads(spark, sf_dir)))
    return usable.select("event_id", "event_type", "timestamp", "score", "num_comments")


@_query
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid(decode_tolerant(_doubtful_payloads(spark, sf_dir)))
    reasons = F.array_join("reasons", ",").alias("reasons")
    return rejected.groupBy(reasons).agg(F.count("*").alias("messages"))


@_query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = with_quality_flags(frames.doubtful_events(spark, sf_dir))
    return flagged.select("event_id", F.array_join("quality_flags", ",").alias("flags"))


# Listings


@_query
def normalize_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = frames.listing_messages(spark, sf_dir).select(
        "endpoint", F.from_json("body", ddl(LISTING_PAGE)).alias("page")
    )
    return to_events(items(pages.select("endpoint", "page.*")))


_NO_PAUSE = {"pause": 0.0}


@_query
def ingest_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages -> raw log -> enrichment -> lake, all as streams."""
    landed, base = scratch_path(spark, "listings"), scratch_path(spark, "flow")
    pages = frames.listing_messages(spark, sf_dir)
    pages.write.partitionBy("endpoint").text(landed)
    raw = f"{base}/raw"
    listing = read_listings(spark, landed, streaming=True)
    run_for(
        streams.ingest_listings(
            listing, raw, f"{base}/c1", trigger=_DRAIN, format="text", quarantine=f"{base}/odd"
        )
    )
    outputs = streams.Outputs(f"{base}/enriched", f"{base}/dlq", f"{base}/bad", format="text")
    log = read_log(spark, raw, format="text")
    run_for(streams.enrich_log(log, LengthProvider, outputs, f"{base}/c2", trigger=_DRAIN, **_NO_PAUSE))
    log = read_log(spark, outputs.enriched, format="text")
    run_for(streams.store_log(log, f"{base}/lake", f"{base}/c3", trigger=_DRAIN))
    return read_lake(spark, f"{base}/lake")


def _is_damaged():
    """Which of ``_doubtful_payloads`` cannot be used, whatever the reason."""
    return (F.col("k") < 40) | F.col("k").between(50, 59) | F.col("k").between(70, 74)


def _routed(spark: SparkSession, sf_dir: str) -> streams.Outputs:
    """Documents and damaged messages through the routed stream."""
    base, log_dir = scratch_path(spark, "routes"), scratch_path(spark, "log")
    publish(frames.document_events(spark, sf_dir), log_dir, format="text")
    damaged = _doubtful_payloads(spark, sf_dir).filter(_is_damaged())
    damaged.select(F.col("payload").alias("value")).write.mode("append").text(log_dir)
    outputs = streams.Outputs(f"{base}/ok", f"{base}/dlq", f"{base}/bad", format="text")
    log = read_log(spark, log_dir, format="text", batch_limit=2)
    run_for(streams.enrich_log(log, LengthProvider, outputs, f"{base}/c", trigger=_DRAIN, **_NO_PAUSE))
    return outputs


@_query
def dead_letter_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider that recovers step by step: its dead letters are asked for again, three times at most."""
    base, log_dir = scratch_path(spark, "retries"), scratch_path(spark, "log")
    publish(frames.document_events(spark, sf_dir), log_dir, format="text")
    outputs = streams.Outputs(f"{base}/ok", f"{base}/dlq", f"{base}/bad", format="text")
    asking = {"trigger": _DRAIN, "attempts": 3, "pause": 0.0}
    log = read_log(spark, log_dir, format="text", batch_limit=2)
    run_for(streams.enrich_log(log, partial(StepProvider, 1), outputs, f"{base}/c0", trigger=_DRAIN, **_NO_PAUSE))
    for step in (2, 3, 4):
        failed = read_log(spark, outputs.dead_letter, format="text")
        run_for(streams.retry_failed(failed, partial(StepProvider, step), outputs, f"{base}/c1", final=f"{base}/final", **asking))
    read = partial(read_log, spark, format="text", streaming=False)
    ok, final = (flatten_enriched(decode(read(x), ENRICHED_EVENT)) for x in (outputs.enriched, f"{base}/final"))
    columns = ["event_id", "sentiment_score", "outcome"]
    return ok.withColumn("outcome", F.lit("enriched")).select(columns).unionByName(
        final.withColumn("outcome", F.lit("given up")).select(columns)
    )


def _read_json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder)


@_query
def route_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose enrichment failed, as published."""
    dead = read_log(spark, _routed(spark, sf_dir).dead_letter, format="text", streaming=False)
    return flatten_enriched(decode(dead, ENRICHED_EVENT))


@_query
def route_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are no valid events, as published."""
    bad = _read_json(spark, _routed(spark, sf_dir).quarantine, "payload string, reasons array<string>")
    return bad.select("payload", F.array_join("reasons", ",").alias("reasons"))


@_query
def log_of_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with checkpoints of their own publish into one log; it holds both."""
    base = scratch_path(spark, "logs")
    for number in range(2):
        part = frames.listing_messages(spark, sf_dir).filter(
            F.col("endpoint") == ("new" if number else "comments")
        )
        part.write.partitionBy("endpoint").text(f"{base}/pages{number}")
        pages = read_listings(spark, f"{base}/pages{number}", streaming=True)
        query = streams.ingest_listings(
            pages,
            f"{base}/raw",
            f"{base}/c{number}",
            trigger=_DRAIN,
            format="text",
            quarantine=f"{base}/odd",
        )
        run_for(query)
    log = read_log(spark, f"{base}/raw", format="text", streaming=False)
    return flatten_raw(decode(log, RAW_EVENT))


def _damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = scratch_path(spark, "listings")
    pages = frames.damaged_listings(spark, sf_dir)
    pages.select("endpoint", "body").write.partitionBy("endpoint").text(landed)
    return read_listings(spark, landed)


@_query
def damaged_listing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = split_items(_damaged_pages(spark, sf_dir))
    return to_events(usable)


@_query
def damaged_listing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_items(_damaged_pages(spark, sf_dir))
    reasons = F.array_join("reasons", ",").alias("reasons")
    return rejected.groupBy("endpoint", reasons).agg(F.count("*").alias("children"))


@_query
def media_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = frames.page_items(spark, sf_dir)
    return pages.select(
        "page_id", media_urls(F.col("item"), F.col("event_type")).alias("media_urls")
    )


@_query
def media_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = frames.page_items(spark, sf_dir)
    found = media_urls(F.col("item"), F.col("event_type"))
    return rates.media_counts(pages.select("event_type", (F.size(found) > 0).alias("has_media")), "event_type")


def _reading_marks(events: DataFrame) -> DataFrame:
    """Per group, the position of its event with the highest score."""
    top = F.max(F.struct("score", "timestamp", "event_id"))
    return events.groupBy("posted_in_subreddit").agg(top.alias("top")).select(
        "posted_in_subreddit", F.struct("top.timestamp", "top.event_id").alias("mark")
    )


@_query
def incremental_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.lake_events(spark, sf_dir).select(
        "posted_in_subreddit", "timestamp", "event_id", "score"
    )
    return cursor.after_marks(events, _reading_marks(events), "posted_in_subreddit")


@_query
def poll_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A poll on top of stored marks: everything ten days earlier was taken before."""
    events = frames.lake_events(spark, sf_dir).select("posted_in_subreddit", "timestamp", "event_id")
    earlier = events.withColumn("timestamp", F.col("timestamp") - F.expr("interval 10 days"))
    path = scratch_path(spark, "marks")
    cursor.save_marks(cursor.high_water_marks(earlier, "posted_in_subreddit"), path, 0)
    marks = cursor.read_marks(spark, path, 0)
    return cursor.after_marks(events, marks, "posted_in_subreddit")


@_query
def poll_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls of a hundred per group, the marks moved on in between."""
    events = frames.lake_events(spark, sf_dir).select("posted_in_subreddit", "timestamp", "event_id")
    path, group, taken = scratch_path(spark, "marks"), "posted_in_subreddit", None
    cursor.save_marks(cursor.high_water_marks(events.limit(0), group), path, 0)
    for number in range(2):
        marks = cursor.read_marks(spark, path, number)
        found = cursor.poll(events, marks, group).withColumn("poll", F.lit(number))
        cursor.save_marks(cursor.advance_marks(marks, found, group), path, number + 1)
        taken = found if taken is None else taken.unionByName(found)
    return taken


@_query
def poll_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.lake_events(spark, sf_dir).select("posted_in_subreddit", "timestamp", "event_id")
    return newest_per_group(events, "posted_in_subreddit", cursor.FETCH_LIMIT)


# Enrichment


# Small enough that a source has several pieces in every given table.
PIECE = 192


def _chunked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir).withColumn("text", prompt_text(F.col("title"), F.col("content")))
    piece = F.floor(F.col("doc_id") / PIECE)
    return enrich.chunk_columns(docs, "title", ["doc_id"], piece)


@_query
def prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir)
    return docs.select("doc_id", prompt_text(F.col("title"), F.col("content")).alias("text"))


@_query
def prompt_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.pack_prompts(_chunked_documents(spark, sf_dir), "title")


@_query
def enrich_dummy(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich.fixed_enrichment(F.col("position"))
    answered = _chunked_documents(spark, sf_dir).select("doc_id", enriched.alias("e"))
    return answered.select(
        "doc_id",
        *[F.col(f"e.{name}").alias(name) for name in ("languages", "translation", "intent", "topics")],
        "e.sentiment_score",
        F.col("e.entities.name").alias("entity_names"),
        F.col("e.entities.type").alias("entity_types"),
    )


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(frames.documents(spark, sf_dir), LengthProvider, **_NO_PAUSE)


@_query
def enrich_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(spark, sf_dir).select(
        "doc_id",
        "status",
        "reason",
        F.col("enrichment.sentiment_score").alias("sentiment_score"),
        F.col("enrichment.topics").alias("topics"),
    )


@_query
def enrich_odd_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lists, nulls, wrong types and values without a JSON form: each fails alone."""
    asked = enrich.enrich(frames.documents(spark, sf_dir), OddProvider, **_NO_PAUSE)
    return asked.select("doc_id", "status", "reason", "attempts", F.col("enrichment.topics").alias("topics"))


@_query
def enrich_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.outcome_counts(_asked(spark, sf_dir), "title")


# Tables


def _reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw events again; the unscored ones moved by a second, so with new keys."""
    moved = F.col("timestamp") + F.expr("interval 1 second")
    time = F.when(F.col("score").isNull(), moved).otherwise(F.col("timestamp"))
    return frames.raw_events(spark, sf_dir).withColumn("timestamp", time)


@_query
def insert_ignore_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = TABLES["raw_events"]
    return new_rows(_reposts(spark, sf_dir), frames.raw_events(spark, sf_dir), table.keys)


@_query
def insert_ignore_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot, merge, and the same merge again."""
    table, path = TABLES["raw_events"], scratch_path(spark, "raw_events")
    replace_table(frames.raw_events(spark, sf_dir), table, path)
    for _ in range(2):
        insert_ignore(_reposts(spark, sf_dir), table, path)
    return read_table(spark, table, path).drop("chunk_start")


@_query
def append_only_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, path = TABLES["raw_events"], scratch_path(spark, "raw_events")
    for _ in range(2):
        append_table(frames.raw_events(spark, sf_dir), table, path)
    return read_table(spark, table, path).drop("chunk_start")


@_query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days, since the given events span less than the default thirty."""
    return retain(frames.lake_events(spark, sf_dir).select("event_id", "timestamp"), 10)


# Rates


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.source_events(spark, sf_dir).select("timestamp", F.col("event_type").alias("stream"))
    return rates.event_rate(events)


@_query
def event_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir)


@_query
def event_rates_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of stored raw and enriched events, from tables to a table."""
    tables, output = scratch_path(spark, "tables"), scratch_path(spark, "rates")
    append_table(frames.raw_events(spark, sf_dir), TABLES["raw_events"], f"{tables}/raw_events")
    enriched = frames.enriched_events(spark, sf_dir).filter("enrichment is not null")
    flat = flatten_enriched(enriched.select(F.struct(*ENRICHED_EVENT).alias("data")))
    append_table(flat, TABLES["enriched_events"], f"{tables}/enriched_events")
    run_rates(spark, tables, output)
    return read_table(spark, TABLES["event_rates"], f"{output}/event_rates").drop("chunk_start")


@_query
def rate_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.latest_rate(_rates(spark, sf_dir))


@_query
def rolling_avg_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rolling_average(_rates(spark, sf_dir))
