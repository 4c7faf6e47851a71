"""Partial states: parts, withdrawn copies, emptied groups, interrupted updates, and what an update reads."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from support import SMALL

from chatterloom.plans import incremental
from chatterloom.plans.batch import JOBS
from workload import frames

SCHEMA = (
    "event_id string, timestamp timestamp, score int, enrichment_sentiment double, "
    "posted_in_subreddit string, enrichment_topics array<string>"
)


def event(event_id, day, sentiment, group="g", topics=("t",), hour=0, score=1):
    return event_id, datetime(2024, 1, day, hour), score, sentiment, group, list(topics)


def state(spark, root):
    daily = incremental.daily_sentiment(spark, root).withColumn("sentiment_stddev", F.round("sentiment_stddev", 6))
    return {(r.day_start.day, r.subreddit): r for r in daily.collect()}, {
        (r.week_start.day, r.topic): r.topic_count for r in incremental.weekly_topics(spark, root).collect()
    }


def expected(events):
    daily = JOBS["daily_sentiment"].result(events).withColumn("sentiment_stddev", F.round("sentiment_stddev", 6))
    return {(r.day_start.day, r.subreddit): r for r in daily.collect()}, {
        (r.week_start.day, r.topic): r.topic_count for r in JOBS["weekly_topics"].result(events).collect()
    }


PARTS = [
    [event("a", 1, 0.5), event("b", 1, -1.0), event("c", 3, None, topics=()), event("n", 3, 0.25, group=None)],
    # a moves to the next day, b is scored anew, c leaves its day empty
    [event("a", 2, 0.75), event("b", 1, 0.0, hour=2, topics=("u", "u")), event("c", 4, 0.5), event("a", 1, 0.5)],
    [event("d", 9, 1.0, group="h"), event("b", 1, 0.0, hour=2, topics=("u", "u")), event("e", 1, -0.25, score=None)],
]


def test_parts_equal_the_whole(spark, path):
    taken = []
    for part in PARTS:
        taken += part
        incremental.update(spark, path("s"), spark.createDataFrame(part, SCHEMA))
        assert state(spark, path("s")) == expected(spark.createDataFrame(taken, SCHEMA))
    incremental.update(spark, path("s"), spark.createDataFrame(taken, SCHEMA))  # nothing new
    assert state(spark, path("s")) == expected(spark.createDataFrame(taken, SCHEMA))
    incremental.update(spark, path("s"), spark.createDataFrame([], SCHEMA))
    assert len(state(spark, path("s"))[0]) == 5


def test_an_interrupted_update_is_finished_once(spark, path, monkeypatch):
    whole = spark.createDataFrame(PARTS[0] + PARTS[1], SCHEMA)
    incremental.update(spark, path("s"), spark.createDataFrame(PARTS[0], SCHEMA))
    replace, calls = incremental._replace, []

    def breaks(rows, target, key):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("the disk went away")
        replace(rows, target, key)

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "_replace", breaks)
        with pytest.raises(OSError):
            incremental.update(spark, path("s"), spark.createDataFrame(PARTS[1], SCHEMA))
    incremental.update(spark, path("s"), spark.createDataFrame(PARTS[1], SCHEMA))
    assert state(spark, path("s")) == expected(whole)


def test_an_update_does_not_read_older_days(spark, path):
    events = frames.lake_events(spark, SMALL)
    last = events.agg(F.max(F.to_date("timestamp"))).first()[0]
    incremental.update(spark, path("s"), events)
    days = incremental.read_state(spark, path("s"), "events", {last, last - timedelta(days=1)})
    plan = days._sc._jvm.PythonSQLUtils.explainString(days._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [" in plan and last.isoformat() in plan
    asked = []
    read = incremental.read_state

    def noted(spark, root, name, folders=None):
        asked.append((name, min(folders)))
        return read(spark, root, name, folders)

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(incremental, "read_state", noted)
        late = events.filter(F.to_date("timestamp") == F.lit(last)).withColumn("score", F.lit(1000))
        incremental.update(spark, path("s"), late)
    assert {name for name, _ in asked} == {"events", "daily", "topics"}
    assert min(day for _, day in asked) >= last - timedelta(days=7) > date(2024, 1, 10)


def test_an_update_is_written_beside_the_state_once(spark, path, monkeypatch):
    """What counts, what no longer does and what stays are one table, the pending one."""
    incremental.update(spark, path("s"), spark.createDataFrame(PARTS[0], SCHEMA))
    labels, scratch = [], incremental.scratch_path
    monkeypatch.setattr(incremental, "scratch_path", lambda spark, label: labels.append(label) or scratch(spark, label))
    replace, held = incremental._replace, {}

    def noted(rows, target, key):
        held[target.rsplit("/", 1)[1]] = {r[0].day for r in rows.select(key).distinct().collect()}
        replace(rows, target, key)

    monkeypatch.setattr(incremental, "_replace", noted)
    incremental.update(spark, path("s"), spark.createDataFrame(PARTS[1][:2], SCHEMA))
    assert labels == ["part"]
    assert held["events"] == {1, 2}  # the third, read as it is near, stays as it is
    assert state(spark, path("s")) == expected(spark.createDataFrame(PARTS[0] + PARTS[1][:2], SCHEMA))
