"""Projections between message, table and lake layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterloom.functions.time import iso_text
from chatterloom.schemas import ENRICHMENT, LAKE_EVENT, RAW_EVENT


def flatten_raw(decoded: DataFrame) -> DataFrame:
    """The raw event columns out of ``data``."""
    return decoded.select([F.col(f"data.{n}").alias(n) for n in RAW_EVENT])


def flatten_enriched(decoded: DataFrame) -> DataFrame:
    """Raw columns plus the enrichment's fields; entities as JSON text."""
    columns = [F.col(f"data.{n}").alias(n) for n in RAW_EVENT]
    for name in ENRICHMENT:
        field = F.col(f"data.enrichment.{name}")
        columns.append((F.to_json(field) if name == "entities" else field).alias(name))
    return decoded.select(columns)


def to_lake_rows(events: DataFrame) -> DataFrame:
    """Lake layout of events that carry an enrichment; the others are dropped.

    Lists are never null in the lake, and entities become two parallel lists.
    """
    def listed(column: Column) -> Column:
        return F.coalesce(column, F.array().cast("array<string>"))

    e = F.col("enrichment")
    return events.filter(e.isNotNull()).select(
        *RAW_EVENT,
        listed(e["languages"]).alias("enrichment_languages"),
        e["translation"].alias("enrichment_translation"),
        e["sentiment_score"].alias("enrichment_sentiment"),
        e["intent"].alias("enrichment_intent"),
        listed(e["topics"]).alias("enrichment_topics"),
        listed(e["entities"]["name"]).alias("enrichment_entity_names"),
        listed(e["entities"]["type"]).alias("enrichment_entity_types"),
    ).select(*LAKE_EVENT)


def to_messages(events: DataFrame, key: str | None = None) -> DataFrame:
    """Events as log messages: JSON ``value`` with explicit nulls, and ``key``."""
    times = [n for n, t in events.dtypes if t.startswith("timestamp")]
    body = events.withColumns({n: iso_text(F.col(n)) for n in times})
    value = F.to_json(F.struct(*[F.col(n) for n in events.columns]), {"ignoreNullFields": "false"})
    message_key = F.lit(None) if key is None else F.col(key)
    return body.select(message_key.cast("string").alias("key"), value.alias("value"))
