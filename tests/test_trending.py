from datetime import datetime, timedelta

from support import plan_text, rows
from pyspark.sql import functions as F

from chatterloom.functions.text import STOP_WORDS
from chatterloom.operators.rates import event_rate, latest_rate, rolling_average
from chatterloom.operators.retention import retain
from chatterloom.operators.trending import (
    first_per_window,
    mark_over_cap,
    per_window,
    texts_per_window,
    trend_topics,
    trend_words,
    trending_topics,
    trending_words,
    tumbling_counts,
    words_of_texts,
)

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def posts(spark, *texts, seconds=0):
    return spark.createDataFrame(
        [(at(seconds), title, content) for title, content in texts],
        "timestamp timestamp, title string, content string",
    )


def words_of(spark, title, content, **options):
    return [r.word for r in trend_words(posts(spark, (title, content)), **options).collect()]


def test_words(spark):
    assert words_of(spark, "Hello, WORLD/what's", None) == ["hello", "world"]
    assert words_of(spark, None, None) == []
    assert words_of(spark, "one four", "https://five.six") == ["four", "five"]
    assert words_of(spark, "مرحبا، بالعالم", "“quoted” word") == ["مرحبا،", "بالعالم", "“quoted”", "word"]
    assert words_of(spark, "long word", "a\tlong\nword") == ["long word", "long", "word"]
    assert words_of(spark, "Would thing", "café", stop_words=("café",)) == ["would", "thing"]
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 42


def test_windows_of_a_row_on_the_border(spark):
    counted = trending_words(posts(spark, ("border border", None), seconds=15))
    assert rows(counted) == [(at(0), at(30), "border", 2), (at(15), at(45), "border", 2)]
    longer = trending_words(posts(spark, ("border", None), seconds=15), window="1 minute", slide="1 minute")
    assert rows(longer) == [(at(0), at(60), "border", 1)]


def test_row_without_time_has_no_window(spark):
    nowhere = posts(spark, ("border", None)).withColumn("timestamp", F.lit(None).cast("timestamp"))
    assert trending_words(nowhere).count() == 0


def test_topics_are_cleaned(spark):
    df = spark.createDataFrame(
        [(at(0), [None, " ", "Sport ", "sport"]), (at(1), []), (at(2), None)],
        "timestamp timestamp, topics array<string>",
    )
    assert [r.topic for r in trend_topics(df).collect()] == ["sport", "sport"]
    assert {(r.topic, r["count"]) for r in trending_topics(df).collect()} == {("sport", 2)}


def test_words_are_counted_before_the_shuffle(spark):
    plan = plan_text(trending_words(posts(spark, ("a b", None), ("c d", None))), "simple")
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange") == 1


def test_tumbling_and_capped_windows(spark):
    df = spark.createDataFrame(
        [(f"{i:02d}", at(i * 25)) for i in range(5)], "event_id string, timestamp timestamp"
    )
    assert rows(tumbling_counts(df)) == [(at(0), at(60), 3), (at(60), at(120), 2)]
    kept = first_per_window(df, 2).select("event_id")
    assert rows(kept) == [("00",), ("01",), ("03",), ("04",)]
    marked = rows(mark_over_cap(df, 2).select("event_id", "over_cap"))
    assert marked == [("00", False), ("01", False), ("02", True), ("03", False), ("04", False)]
    assert all(r.over_cap for r in mark_over_cap(df, 0).collect())


def test_rates(spark):
    minutes = [0, 0, 1, 4, 4, 4, 10]
    df = spark.createDataFrame(
        [("s", at(60 * m + 5)) for m in minutes] + [("other", at(0))], "stream string, timestamp timestamp"
    )
    rates = event_rate(df)
    per_minute = rows(rates.filter("stream = 's'").select("minute_start", "events"))
    assert per_minute == [(at(0), 2), (at(60), 1), (at(240), 3), (at(600), 1)]
    assert rows(latest_rate(rates)) == [("other", at(0), 1), ("s", at(600), 1)]
    averages = rows(rolling_average(rates).filter("stream = 's'").select("minute_start", "rolling_avg"))
    assert averages == [(at(0), 2.0), (at(60), 1.5), (at(240), 2.0), (at(600), 1.0)]


def test_retain(spark):
    df = spark.createDataFrame([(T0 + timedelta(days=d),) for d in range(40)], "timestamp timestamp")
    assert retain(df, 30).count() == 31
    assert retain(df, 30, as_of=T0 + timedelta(days=45)).count() == 25
    assert retain(df.filter("false"), 30).count() == 0


def test_sliding_windows_count_each_row_once_before_the_shuffle(spark):
    """A batch shuffles panes, of which each row has one, not the windows, and finds the same counts."""
    events = spark.createDataFrame(
        [(at(7 * n - 200), f"word{n % 3} other{n}", "again again") for n in range(60)] + [(None, "word0", "lost")],
        "timestamp timestamp, title string, content string",
    )
    for size, slide in (("30 seconds", "15 seconds"), ("1 minute", "1 minute"), ("45 seconds", "15 seconds"), ("40 seconds", "15 seconds")):
        found = trending_words(events, window=size, slide=slide)
        plain = per_window(trend_words(events), ["word"], size=size, every=slide)
        assert rows(found) == rows(plain) and found.dtypes == plain.dtypes
    assert "Expand" not in plan_text(trending_words(events), "simple")
    topics = events.selectExpr("timestamp", "split(title, ' ') AS topics")
    assert rows(trending_topics(topics)) == rows(per_window(trend_topics(topics), ["topic"], size="30 seconds", every="15 seconds"))


def test_words_of_texts_are_the_words_of_their_events(spark):
    texts = [("Border, border/What's", "“quoted” مرحبا، \t long\nword"), ("border", None), (None, "the and"), (None, None), ("", " ."), ("border", None)]
    events = posts(spark, *texts).unionByName(posts(spark, *texts, seconds=20)).unionByName(posts(spark, ("border lost", None)).withColumn("timestamp", F.lit(None).cast("timestamp")))
    for stop_words, options in ((STOP_WORDS, {}), (("border",), {"window": "1 minute", "slide": "20 seconds"}), ((), {"window": "10 seconds", "slide": "10 seconds"})):
        kept = texts_per_window(events, stop_words, **options)
        found, plain = words_of_texts(kept), trending_words(events, stop_words, **options)
        assert rows(found) == rows(plain) and found.dtypes == plain.dtypes
    assert texts_per_window(events).agg(F.max("texts")).first()[0] == 4
    assert plan_text(texts_per_window(events), "simple").count("split(") == 1
