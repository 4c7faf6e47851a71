"""Column layouts of every record and table, as Spark DDL types.

Layouts are plain ``{column: type}`` mappings so that a job can ask for just
the columns it needs (``ddl(RAW_EVENT, ["timestamp", "title"])``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW_EVENT = {
    "event_id": "string",
    "event_type": "string",
    "posted_in_subreddit": "string",
    "author": "string",
    "url": "string",
    "title": "string",
    "content": "string",
    "timestamp": "timestamp",
    "has_media": "boolean",
    "media_urls": "array<string>",
    "score": "int",
    "upvote_ratio": "double",
    "num_comments": "int",
    "is_crosspost": "boolean",
    "original_subreddit": "string",
}

ENRICHMENT = {
    "languages": "array<string>",
    "translation": "string",
    "sentiment_score": "double",
    "intent": "string",
    "topics": "array<string>",
    "entities": "array<struct<name:string,type:string>>",
}


def struct_type(fields: Mapping[str, str]) -> str:
    """The mapping as a ``struct<...>`` type."""
    return "struct<" + ",".join(f"`{n}`:{t}" for n, t in fields.items()) + ">"


def ddl(fields: Mapping[str, str], names: Iterable[str] | None = None) -> str:
    """The mapping (or a subset of it) as a DDL schema string."""
    names = list(fields) if names is None else list(names)
    return ", ".join(f"`{n}` {fields[n]}" for n in names)


ENRICHED_EVENT = {**RAW_EVENT, "enrichment": struct_type(ENRICHMENT)}

# Raw event plus the enrichment as top-level columns; entities as JSON text.
FLAT_ENRICHED_EVENT = {**RAW_EVENT, **ENRICHMENT, "entities": "string"}

LAKE_ENRICHMENT = {
    "enrichment_languages": "array<string>",
    "enrichment_translation": "string",
    "enrichment_sentiment": "double",
    "enrichment_intent": "string",
    "enrichment_topics": "array<string>",
    "enrichment_entity_names": "array<string>",
    "enrichment_entity_types": "array<string>",
}
LAKE_PARTITIONS = {"year": "int", "month": "int", "day": "int"}
LAKE_EVENT = {**RAW_EVENT, **LAKE_ENRICHMENT}

_MEDIA_SOURCE = struct_type({"s": struct_type({"u": "string", "gif": "string"})})
# Read as text and cast tolerantly, as in messages: name -> the type meant.
LISTING_ITEM_TYPES = {
    "created_utc": "timestamp",
    "score": "int",
    "upvote_ratio": "double",
    "num_comments": "int",
    "is_video": "boolean",
    "is_gallery": "boolean",
    "is_crosspost": "boolean",
}
LISTING_ITEM = {
    "name": "string",
    "id": "string",
    "subreddit": "string",
    "author": "string",
    "created_utc": "string",
    "url": "string",
    "link_url": "string",
    "title": "string",
    "link_title": "string",
    "selftext": "string",
    "body": "string",
    "score": "string",
    "upvote_ratio": "string",
    "num_comments": "string",
    "is_video": "string",
    "secure_media": struct_type(
        {"reddit_video": struct_type({"fallback_url": "string"})}
    ),
    "is_gallery": "string",
    "media_metadata": f"map<string,{_MEDIA_SOURCE}>",
    "post_hint": "string",
    "is_crosspost": "string",
    "crosspost_parent_list": f"array<{struct_type({'subreddit': 'string'})}>",
}
LISTING_PAGE = {
    "data": struct_type(
        {"children": f"array<{struct_type({'data': struct_type(LISTING_ITEM)})}>"}
    )
}

REQUIRED = ("event_id", "event_type", "posted_in_subreddit", "author", "url", "timestamp")

# The closed domains of the data model.
EVENT_TYPES = ("POST", "COMMENT")
LANGUAGES = ("en", "fr", "ar", "darija_ar", "darija_lat")
INTENTS = (
    "question",
    "complaint",
    "discussion",
    "support_request",
    "meme_joke",
    "news_sharing",
    "story_time",
)
ENTITY_TYPES = ("Person", "Organization", "Location")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` itself, or an error that names the columns it lacks."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"input lacks required columns: {', '.join(missing)}")
    return df


@dataclass(frozen=True)
class Table:
    """A result table: its columns, its unique key and its time column."""

    columns: Mapping[str, str]
    keys: tuple[str, ...]
    time: str

    def conform(self, df: DataFrame) -> DataFrame:
        """``df`` with exactly this table's columns, by name, in its types."""
        return df.select([F.col(n).cast(t).alias(n) for n, t in self.columns.items()])


_SENTIMENT_MEASURES = {
    "avg_sentiment": "double",
    "sentiment_count": "bigint",
    "post_count": "bigint",
    "avg_score": "double",
    "sentiment_stddev": "double",
    "sentiment_min": "double",
    "sentiment_max": "double",
    "sample_event_ids": "array<string>",
}
_WINDOW = {"window_start": "timestamp", "window_end": "timestamp"}

TABLES = {
    "raw_events": Table(RAW_EVENT, ("event_id", "timestamp"), "timestamp"),
    "enriched_events": Table(FLAT_ENRICHED_EVENT, ("event_id", "timestamp"), "timestamp"),
    "trending_words_metrics": Table(
        {**_WINDOW, "word": "string", "count": "bigint"},
        ("window_start", "window_end", "word"),
        "window_start",
    ),
    "trending_topics_metrics": Table(
        {**_WINDOW, "topic": "string", "count": "bigint"},
        ("window_start", "window_end", "topic"),
        "window_start",
    ),
    "tumbling_counts_metrics": Table(
        {**_WINDOW, "count": "bigint"}, ("window_start", "window_end"), "window_start"
    ),
    "event_rates": Table(
        {"stream": "string", "minute_start": "timestamp", "events": "bigint", "rolling_avg": "double"},
        ("stream", "minute_start"),
        "minute_start",
    ),
    "batch_daily_sentiment": Table(
        {"day_start": "timestamp", "subreddit": "string", **_SENTIMENT_MEASURES},
        ("day_start", "subreddit"),
        "day_start",
    ),
    "batch_hourly_sentiment": Table(
        {"hour_start": "timestamp", "subreddit": "string", **_SENTIMENT_MEASURES},
        ("hour_start", "subreddit"),
        "hour_start",
    ),
    "batch_topic_sentiment": Table(
        {
            "day_start": "timestamp",
            "topic": "string",
            "avg_sentiment": "double",
            "sentiment_count": "bigint",
            "post_count": "bigint",
        },
        ("day_start", "topic"),
        "day_start",
    ),
    "batch_top_posts": Table(
        {
            "day_start": "timestamp",
            "subreddit": "string",
            "event_id": "string",
            "title": "string",
            "score": "int",
            "sentiment_score": "double",
        },
        ("day_start", "subreddit", "event_id"),
        "day_start",
    ),
    "batch_weekly_topics": Table(
        {"week_start": "timestamp", "topic": "string", "topic_count": "bigint"},
        ("week_start", "topic"),
        "week_start",
    ),
}
