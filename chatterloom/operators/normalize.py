"""Listing items -> raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterloom.functions.casts import TOLERANT
from chatterloom.functions.media import media_urls
from chatterloom.schemas import LISTING_ITEM_TYPES, RAW_EVENT


def typed_item(item: Column) -> Column:
    """The item with its scalars in their types, cast as those of messages are."""
    for name, kind in LISTING_ITEM_TYPES.items():
        item = item.withField(name, TOLERANT[kind](item[name].cast("string")))
    return item


def to_events(items: DataFrame) -> DataFrame:
    """Raw events of listing items (columns ``event_type`` and ``item``).

    Posts and comments keep link, title and text under different names. The
    group of the first crosspost parent is kept for crossposts.
    """
    items = items.withColumn("item", typed_item(F.col("item")))
    item = F.col("item")
    is_post = F.col("event_type") == "POST"

    def either(post_field: str, comment_field: str) -> Column:
        return F.when(is_post, item[post_field]).otherwise(
            F.coalesce(item[comment_field], F.lit(""))
        )

    parent = F.try_element_at(item["crosspost_parent_list"], F.lit(1))
    events = items.select(
        F.coalesce(item["name"], item["id"], F.lit("")).alias("event_id"),
        "event_type",
        F.coalesce(item["subreddit"], F.lit("")).alias("posted_in_subreddit"),
        F.coalesce(item["author"], F.lit("[deleted]")).alias("author"),
        either("url", "link_url").alias("url"),
        either("title", "link_title").alias("title"),
        either("selftext", "body").alias("content"),
        F.coalesce(item["created_utc"], F.timestamp_seconds(F.lit(0))).alias("timestamp"),
        media_urls(item, F.col("event_type")).alias("media_urls"),
        item["score"].alias("score"),
        item["upvote_ratio"].alias("upvote_ratio"),
        item["num_comments"].alias("num_comments"),
        F.coalesce(item["is_crosspost"], F.lit(False)).alias("is_crosspost"),
        F.when(item["is_crosspost"], parent["subreddit"]).alias("original_subreddit"),
    )
    return events.withColumn("has_media", F.size("media_urls") > 0).select(*RAW_EVENT)
