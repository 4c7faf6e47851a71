import os
from datetime import date, datetime

import pytest
from support import plan_text, rows
from pyspark.sql import functions as F

from chatterloom.functions.time import chunk_bounds, chunk_start
from chatterloom.operators.dedup import dedup_latest, dedup_report
from chatterloom.operators.ranking import first_per_group, top_posts
from chatterloom.operators.sentiment import sentiment_by_group, sentiment_by_topic, weekly_topics
from chatterloom.plans.batch import JOBS, run_job, run_jobs
from chatterloom.schemas import LAKE_EVENT, TABLES
from chatterloom.sinks.ageing import drop_days_before
from chatterloom.sinks.lake import write_lake
from chatterloom.sinks.tables import read_table, replace_table
from chatterloom.sources.lake import read_lake

DAY = datetime(2024, 1, 1)
EVENT = (
    "event_id string, timestamp timestamp, posted_in_subreddit string, title string, score int, "
    "enrichment_sentiment double, enrichment_topics array<string>"
)


def event(event_id, when=DAY, group="g", title="t", score=1, sentiment=0.5, topics=("a",)):
    return (event_id, when, group, title, score, sentiment, None if topics is None else list(topics))


def lake_rows(spark, events):
    df = spark.createDataFrame(events, EVENT)
    missing = [F.lit(None).cast(t).alias(n) for n, t in LAKE_EVENT.items() if n not in df.columns]
    return df.select("*", *missing)


def test_latest_copy_survives(spark):
    copies = [event("a", DAY.replace(hour=h), score=h) for h in (3, 9, 5)]
    copies += [event("b", score=None), event("b", score=7), event(None), event(None)]
    kept = rows(dedup_latest(spark.createDataFrame(copies, EVENT)).select("event_id", "score"), "event_id")
    assert kept == [(None, 1), ("a", 9), ("b", 7)]


def test_dedup_report(spark):
    df = spark.createDataFrame([event("a"), event("a"), event("b"), event(None), event(None)], EVENT)
    assert rows(dedup_report(df)) == [(5, 3, 2)]
    assert rows(dedup_report(df.filter("false"))) == [(0, 0, 0)]


def test_copies_are_thinned_before_the_shuffle(spark):
    plan = plan_text(dedup_latest(spark.createDataFrame([event("a"), event("b")], EVENT)), "simple")
    below_shuffle = plan[plan.index("Exchange hashpartitioning(event_id") :]
    assert "row_number(), 1, Partial" in below_shuffle


def test_unscored_and_unrated_events(spark):
    df = spark.createDataFrame(
        [event("a", sentiment=None), event("b", sentiment=0.25, score=None), event("c", group=None)], EVENT
    )
    got = {r.subreddit: r for r in sentiment_by_group(df, "day").collect()}
    assert (got["g"].avg_sentiment, got["g"].sentiment_count, got["g"].post_count) == (0.25, 1, 2)
    assert got["g"].avg_score == 1.0 and got["g"].sentiment_stddev == 0.0
    assert got["g"].sample_event_ids == ["a", "b"]
    assert got[None].sample_event_ids == ["c"]


def test_sample_is_ten_smallest_ids(spark):
    df = spark.createDataFrame([event(f"{i:02d}") for i in range(25, 0, -1)], EVENT)
    (row,) = sentiment_by_group(df, "hour").collect()
    assert row.hour_start == DAY
    assert row.sample_event_ids == [f"{i:02d}" for i in range(1, 11)]


def test_top_posts_ties_and_nulls(spark):
    tied = [event(f"{i:02d}", score=5) for i in range(12)]
    df = spark.createDataFrame([*tied, event("zz", score=9), event("00n", score=None)], EVENT)
    ids = [r.event_id for r in top_posts(df).orderBy(F.desc("score"), "event_id").collect()]
    assert ids == ["zz", *[f"{i:02d}" for i in range(9)]]
    few = spark.createDataFrame([event("a", score=None), event("b", score=-3)], EVENT)
    assert rows(top_posts(few).select("event_id", "score")) == [("a", None), ("b", -3)]


def test_first_per_group_beyond_the_map_side_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100")
    try:
        got = rows(first_per_group(df, ["g"], [F.asc("id")], 1000))
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
    assert got == sorted((i % 2, i) for i in range(2000))


def test_topics_count_raw_and_repeated(spark):
    topics = [None, [], [None, " ", "Sport ", "sport", "sport"]]
    df = spark.createDataFrame([event(str(i), topics=t) for i, t in enumerate(topics)], EVENT)
    by_topic = rows(sentiment_by_topic(df).select("topic", "post_count"), "topic")
    assert by_topic == [(None, 1), (" ", 1), ("Sport ", 1), ("sport", 2)]


def test_week_starts_on_monday(spark):
    df = spark.createDataFrame(
        [event("a", datetime(2024, 1, 7, 12)), event("b", datetime(2024, 1, 8))], EVENT
    )
    weeks = rows(weekly_topics(df), "week_start")
    assert weeks == [(datetime(2024, 1, 1), "a", 1), (datetime(2024, 1, 8), "a", 1)]


def test_missing_column_is_named(spark):
    df = spark.createDataFrame([event("a")], EVENT).drop("enrichment_sentiment")
    with pytest.raises(ValueError, match="enrichment_sentiment"):
        sentiment_by_group(df, "day")
    with pytest.raises(ValueError, match="enrichment_sentiment"):
        JOBS["topic_sentiment"].result(df)
    with pytest.raises(ValueError, match="grain"):
        sentiment_by_group(spark.createDataFrame([event("a")], EVENT), "year")


def test_daily_plan_shares_dedup_and_reduces_early(spark):
    df = spark.createDataFrame([event("a"), event("b")], EVENT)
    result = JOBS["daily_sentiment"].result(df)
    result.collect()
    plan = plan_text(result, "simple")
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final and "partial_avg" in final and final.count("Partial") >= 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def _lake(spark, path):
    events = [
        event(f"{d:02d}-{i}", datetime(2024, 1, d, 5, i), score=i, topics=("x", f"y{i}"))
        for d in range(1, 22)
        for i in range(3)
    ]
    write_lake(lake_rows(spark, events + events[:5]), path)
    return events


def test_lake_layout_and_pruning(spark, path, tmp_path):
    lake = path("lake")
    events = _lake(spark, lake)
    assert (tmp_path / "lake" / "year=2024" / "month=01" / "day=07").is_dir()
    some = read_lake(spark, lake, since=date(2024, 1, 3), until=date(2024, 1, 5))
    assert some.count() == 6
    folders = {file.rsplit("/", 2)[-2] for file in some.inputFiles()}
    assert folders == {"day=03", "day=04"}  # the others are not even listed
    assert "ReadSchema: struct<event_id:string>" in plan_text(some.select("event_id"))
    onward = read_lake(spark, lake, since=date(2024, 1, 20))
    plan = plan_text(onward.select("event_id"))
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "make_date" in filters and onward.count() == 6
    assert read_lake(spark, lake, since=date(2030, 1, 1), until=date(2030, 1, 2)).count() == 0
    everything = read_lake(spark, lake)
    assert everything.count() == len(events) + 5
    assert dict(everything.dtypes)["timestamp"] == "timestamp"


def test_late_schema_is_fixed(spark, path):
    write_lake(lake_rows(spark, [event("a", title=None, topics=None)]), path("lake"))
    write_lake(lake_rows(spark, [event("b", title="t")]), path("lake"))
    assert rows(read_lake(spark, path("lake")).select("event_id", "title")) == [("a", None), ("b", "t")]


def test_jobs_alone_and_together(spark, path):
    _lake(spark, path("lake"))
    run_jobs(spark, path("lake"), path("all"))
    for name, job in JOBS.items():
        table = TABLES[job.table]
        run_job(spark, name, path("lake"), path("one"))
        together = read_table(spark, table, f"{path('all')}/{job.table}")
        alone = read_table(spark, table, f"{path('one')}/{job.table}")
        assert together.count() > 0
        assert together.exceptAll(alone).count() == 0 and alone.exceptAll(together).count() == 0
        assert together.groupBy(*table.keys).count().filter("count > 1").count() == 0


def test_bounded_run_replaces_whole_chunks_only(spark, path):
    _lake(spark, path("lake"))
    run_job(spark, "weekly_topics", path("lake"), path("out"))
    table = TABLES["batch_weekly_topics"]
    stored = f"{path('out')}/batch_weekly_topics"
    before = rows(read_table(spark, table, stored))
    run_job(
        spark,
        "weekly_topics",
        path("lake"),
        path("out"),
        since=date(2024, 1, 10),
        until=date(2024, 1, 11),
    )
    assert rows(read_table(spark, table, stored)) == before


def test_bounded_runs_equal_the_whole_run(spark, path):
    """Copies on both sides of a week's end, and a week that loses its last event."""
    events = [
        event("a", datetime(2024, 1, 7, 23, 59, 50)),
        event("a", datetime(2024, 1, 8, 0, 0, 10)),
        event("b", datetime(2024, 1, 15, 0, 0, 1)),
    ]
    write_lake(lake_rows(spark, events), path("lake"))
    run_job(spark, "daily_sentiment", path("lake"), path("whole"))
    old = lake_rows(spark, [event("gone", datetime(2024, 1, 3))])
    stale = JOBS["daily_sentiment"].result(old)
    table = TABLES["batch_daily_sentiment"]
    replace_table(stale, table, f"{path('parts')}/batch_daily_sentiment")
    for day in (1, 8, 15):
        bounds = {"since": date(2024, 1, day), "until": date(2024, 1, day + 7)}
        run_job(spark, "daily_sentiment", path("lake"), path("parts"), **bounds)
    whole, parts = (
        rows(read_table(spark, table, f"{path(p)}/batch_daily_sentiment").select("day_start", "post_count"))
        for p in ("whole", "parts")
    )
    assert whole == parts == [(datetime(2024, 1, 8), 1), (datetime(2024, 1, 15), 1)]


def test_chunks(spark):
    assert chunk_bounds(date(2024, 1, 10), date(2024, 1, 11), 7) == (date(2024, 1, 8), date(2024, 1, 15))
    assert chunk_bounds(None, date(2024, 1, 15), 7) == (None, date(2024, 1, 15))
    days = spark.createDataFrame([(datetime(2024, 1, 14, 23),), (datetime(1969, 12, 30),)], "t timestamp")
    got = [r[0] for r in days.select(chunk_start(F.col("t"), 7)).collect()]
    assert got == [date(2024, 1, 8), date(1969, 12, 29)]


def test_old_days_are_dropped(spark, path):
    _lake(spark, path("lake"))
    dropped = drop_days_before(spark, path("lake"), 5, date(2024, 1, 21))
    assert dropped == [date(2024, 1, d) for d in range(1, 16)]
    os.makedirs(path("lake") + "/year=__HIVE_DEFAULT_PARTITION__/month=01/day=01")
    assert drop_days_before(spark, path("lake"), 5, date(2024, 1, 21)) == []
    assert read_lake(spark, path("lake")).agg(F.min("day")).first()[0] == 16
