"""Incremental reads: only what lies behind the last event taken.

The position of every group is a mark, (timestamp, event_id), kept in a small
table. A poll reads the marks, never the store; after its events are stored,
the marks move on to the last of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.operators.ranking import first_per_group

FETCH_LIMIT = 100


def _position():
    return F.struct("timestamp", "event_id")


def high_water_marks(events: DataFrame, group: str) -> DataFrame:
    """Newest (timestamp, event_id) among ``events``, one row per group, in one scan."""
    return events.groupBy(group).agg(F.max(_position()).alias("mark"))


def advance_marks(marks: DataFrame, taken: DataFrame, group: str) -> DataFrame:
    """The marks after ``taken`` was stored."""
    both = marks.unionByName(high_water_marks(taken, group))
    return both.groupBy(group).agg(F.max("mark").alias("mark"))


def after_marks(events: DataFrame, marks: DataFrame, group: str) -> DataFrame:
    """Events newer than their group's mark; groups without a mark are all new."""
    new = F.col("mark").isNull() | (_position() > F.col("mark"))
    return events.join(marks, group, "left").filter(new).drop("mark")


def poll(events: DataFrame, marks: DataFrame, group: str, limit: int = FETCH_LIMIT) -> DataFrame:
    """What one poll takes: the ``limit`` oldest unseen events per group.

    The next poll goes on where this one ended, so none is lost.
    """
    order = [F.asc("timestamp"), F.asc("event_id")]
    return first_per_group(after_marks(events, marks, group), [group], order, limit)


def save_marks(marks: DataFrame, path: str, version: int) -> None:
    """Writes one version of the marks; a repeated version replaces itself."""
    marks.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_marks(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")
