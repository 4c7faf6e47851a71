"""First n rows per group, and the reports built on it.

Each rank is a ``row_number`` filtered by a constant, which Spark evaluates on
the map side first: a task ships at most n rows per group, however large the
group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterloom.functions.time import bucket_start

_RANK = "_rank"


def first_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of every group in the given total order.

    Keep ``n`` within ``spark.sql.optimizer.windowGroupLimitThreshold``, the
    bound up to which Spark ranks on the map side; ``build_session`` raises it.
    """
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) <= n).drop(_RANK)


def top_posts(events: DataFrame, n: int = 10) -> DataFrame:
    """Per day and group, the ``n`` events with the highest score.

    Posts and comments compete; unscored events come last, ties go to the
    smaller event id.
    """
    day = events.select(
        bucket_start("day", F.col("timestamp")).alias("day_start"),
        F.col("posted_in_subreddit").alias("subreddit"),
        "event_id",
        "title",
        "score",
        F.col("enrichment_sentiment").alias("sentiment_score"),
    )
    order = [F.desc_nulls_last("score"), F.asc("event_id")]
    return first_per_group(day, ["day_start", "subreddit"], order, n)


def newest_per_group(events: DataFrame, group: str, n: int) -> DataFrame:
    """The ``n`` newest events of every group, ties by smaller event id."""
    order = [F.desc_nulls_last("timestamp"), F.asc("event_id")]
    return first_per_group(events, [group], order, n)
