"""Sentiment per time bucket and group or topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.functions.time import bucket_start
from chatterloom.operators.ranking import first_per_group
from chatterloom.schemas import require_columns

SAMPLE_IDS = 10


def sentiment_by_group(events: DataFrame, grain: str) -> DataFrame:
    """Sentiment and score measures per ``grain`` bucket and group.

    ``sample_event_ids`` are the ten smallest ids. They are ranked apart from
    the measures so that both sides reduce on the map side and no task ever
    holds the ids of a whole group.
    """
    require_columns(events, ["enrichment_sentiment"])
    start = bucket_start(grain, F.col("timestamp")).alias("start")
    # One struct as the key on both sides: the join reuses the partitioning of
    # the aggregations, and a null group equals itself.
    rows = events.select(
        F.struct(start, F.col("posted_in_subreddit").alias("subreddit")).alias("bucket"),
        "event_id",
        "enrichment_sentiment",
        "score",
    )
    measures = rows.groupBy("bucket").agg(
        F.avg("enrichment_sentiment").alias("avg_sentiment"),
        F.count("enrichment_sentiment").alias("sentiment_count"),
        F.count("*").alias("post_count"),
        F.avg("score").alias("avg_score"),
        F.stddev_pop("enrichment_sentiment").alias("sentiment_stddev"),
        F.min("enrichment_sentiment").alias("sentiment_min"),
        F.max("enrichment_sentiment").alias("sentiment_max"),
    )
    ids = rows.select("bucket", "event_id")
    samples = (
        first_per_group(ids, ["bucket"], [F.asc_nulls_last("event_id")], SAMPLE_IDS)
        .groupBy("bucket")
        .agg(F.array_sort(F.collect_list("event_id")).alias("sample_event_ids"))
    )
    return measures.join(samples, "bucket").select(
        F.col("bucket.start").alias(f"{grain}_start"),
        F.col("bucket.subreddit").alias("subreddit"),
        *measures.columns[1:],
        "sample_event_ids",
    )


def sentiment_by_topic(events: DataFrame) -> DataFrame:
    """Sentiment per day and topic; a topic named twice by an event counts twice."""
    require_columns(events, ["enrichment_sentiment", "enrichment_topics"])
    mentions = events.select(
        bucket_start("day", F.col("timestamp")).alias("day_start"),
        "enrichment_sentiment",
        F.explode("enrichment_topics").alias("topic"),
    )
    return mentions.groupBy("day_start", "topic").agg(
        F.avg("enrichment_sentiment").alias("avg_sentiment"),
        F.count("enrichment_sentiment").alias("sentiment_count"),
        F.count("*").alias("post_count"),
    )


def weekly_topics(events: DataFrame) -> DataFrame:
    """Topic mentions per ISO week."""
    require_columns(events, ["enrichment_topics"])
    mentions = events.select(
        bucket_start("week", F.col("timestamp")).alias("week_start"),
        F.explode("enrichment_topics").alias("topic"),
    )
    return mentions.groupBy("week_start", "topic").agg(F.count("*").alias("topic_count"))
