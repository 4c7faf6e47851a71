"""Row rules: which events are usable, and which look doubtful."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterloom.operators.decode import CORRUPT
from chatterloom.schemas import ENTITY_TYPES, EVENT_TYPES, INTENTS, LANGUAGES, REQUIRED

# Fixed value: topics an enrichment should name.
TOPIC_COUNT = (2, 4)


def _names_of(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules whose condition holds."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def _outside(value: Column, domain: tuple[str, ...]) -> Column:
    """Whether a value is none of the domain; null is none."""
    return ~F.coalesce(value.isin(*domain), F.lit(False))


def with_violations(events: DataFrame) -> DataFrame:
    """Adds ``violations``: why a tolerantly decoded event is unusable, if it is."""
    corrupt = F.col(CORRUPT).isNotNull()
    rules = [("corrupt", corrupt)]
    for name in REQUIRED:
        missing = F.col(name).isNull()
        if name == "event_id":
            missing = F.coalesce(F.col(name), F.lit("")) == ""
        rules.append((f"{name}:missing", ~corrupt & missing))
    rules.append(("event_type:unknown", ~F.col("event_type").isin(*EVENT_TYPES)))
    if "enrichment" in events.columns:
        languages = F.exists("enrichment.languages", lambda code: _outside(code, LANGUAGES))
        rules.append(("enrichment.languages:unknown", languages))
        topics = F.exists("enrichment.topics", lambda topic: topic.isNull())
        rules.append(("enrichment.topics:null", topics))
    miscast = F.transform("_miscast", lambda name: F.concat(name, F.lit(":type")))
    return events.withColumn("violations", F.concat(_names_of(rules), miscast))


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable events, quarantined payloads with their reasons)."""
    return split_checked(with_violations(events))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``split_valid`` of events that have their violations."""
    helpers = ("payload", CORRUPT, "_miscast", "violations")
    usable = checked.filter(F.size("violations") == 0).drop(*helpers)
    rejected = checked.filter(F.size("violations") > 0).select(
        "payload", F.col("violations").alias("reasons")
    )
    return usable, rejected


def with_quality_flags(events: DataFrame) -> DataFrame:
    """Adds ``quality_flags``: enrichment values outside their stated domains.

    The flags report; they never remove a row.
    """
    e = F.col("enrichment")
    rules = [
        ("languages", F.exists(e["languages"], lambda code: _outside(code, LANGUAGES))),
        ("sentiment_score", ~e["sentiment_score"].between(-1.0, 1.0)),
        ("intent", ~e["intent"].isin(*INTENTS)),
        ("topics", ~F.size(e["topics"]).between(*TOPIC_COUNT)),
        ("entities", F.exists(e["entities"], lambda x: _outside(x["type"], ENTITY_TYPES))),
    ]
    return events.withColumn("quality_flags", _names_of(rules))
