"""Operators against plain Python on random rows where one key holds a third of them."""

import random
import re
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatterloom.functions.text import STOP_WORDS, prompt_text, words
from chatterloom.operators.rates import event_rate, rolling_average
from chatterloom.operators.trending import trending_words
from chatterloom.plans.batch import JOBS

T0 = datetime(2024, 1, 1)
ROWS = 3000


@pytest.fixture(scope="module")
def events():
    rng = random.Random(7)

    def one(i):
        hot = i % 3 == 0
        return {
            "event_id": "hot" if hot else f"e{rng.randrange(1200)}",
            "timestamp": T0 + timedelta(minutes=rng.randrange(60 * 24 * 9)),
            "posted_in_subreddit": "big" if rng.random() < 0.4 else f"g{rng.randrange(4)}",
            "title": rng.choice(["x", "y", None]),
            "score": rng.choice([None, *range(6)]),
            "enrichment_sentiment": rng.choice([None, -0.5, 0.25, 0.75]),
            "enrichment_topics": rng.sample(["a", "b", " c", ""], rng.randrange(4)) or None,
        }

    return [one(i) for i in range(ROWS)]


SCHEMA = (
    "event_id string, timestamp timestamp, posted_in_subreddit string, title string, score int, "
    "enrichment_sentiment double, enrichment_topics array<string>"
)


@pytest.fixture(scope="module")
def frame(spark, events):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(e[n] for n in names) for e in events], SCHEMA).repartition(6)


def low(value):
    """Nulls below everything."""
    return (value is not None, value if value is not None else 0)


def survivors(events, extra):
    """Latest copies; ties as a job with the given extra columns breaks them."""
    best = {}
    for e in events:
        key = (e["timestamp"], low(e["score"]), low(e["enrichment_sentiment"]))
        key += tuple((e[n] is not None, e[n] or ([] if n.endswith("topics") else "")) for n in extra)
        if e["event_id"] not in best or key > best[e["event_id"]][0]:
            best[e["event_id"]] = (key, e)
    return [e for _, e in best.values()]


def day(e):
    return e["timestamp"].replace(hour=0, minute=0)


def test_daily_sentiment(frame, events):
    groups = defaultdict(list)
    for e in survivors(events, ["posted_in_subreddit"]):
        groups[day(e), e["posted_in_subreddit"]].append(e)
    got = {(r.day_start, r.subreddit): r for r in JOBS["daily_sentiment"].result(frame).collect()}
    assert set(got) == set(groups)
    for key, members in groups.items():
        moods = [e["enrichment_sentiment"] for e in members if e["enrichment_sentiment"] is not None]
        row = got[key]
        assert row.post_count == len(members) and row.sentiment_count == len(moods)
        assert row.sample_event_ids == sorted(e["event_id"] for e in members)[:10]
        if moods:
            assert row.avg_sentiment == pytest.approx(statistics.mean(moods))
            assert row.sentiment_stddev == pytest.approx(statistics.pstdev(moods))
            assert (row.sentiment_min, row.sentiment_max) == (min(moods), max(moods))


def test_top_posts(frame, events):
    groups = defaultdict(list)
    for e in survivors(events, ["posted_in_subreddit", "title"]):
        groups[day(e), e["posted_in_subreddit"]].append(e)
    expected = set()
    for key, members in groups.items():
        ranked = sorted(members, key=lambda e: e["event_id"])
        ranked.sort(key=lambda e: low(e["score"]), reverse=True)
        expected |= {(*key, e["event_id"], e["score"]) for e in ranked[:10]}
    got = {(r.day_start, r.subreddit, r.event_id, r.score) for r in JOBS["top_posts"].result(frame).collect()}
    assert got == expected


def test_weekly_topics(frame, events):
    counts = defaultdict(int)
    for e in survivors(events, ["enrichment_topics"]):
        week = day(e) - timedelta(days=e["timestamp"].weekday())
        for topic in e["enrichment_topics"] or []:
            counts[week, topic] += 1
    got = {(r.week_start, r.topic): r.topic_count for r in JOBS["weekly_topics"].result(frame).collect()}
    assert got == counts


def test_rolling_average(frame, events):
    per_minute = defaultdict(int)
    for e in events:
        per_minute[e["posted_in_subreddit"], e["timestamp"]] += 1
    rates = event_rate(frame, "posted_in_subreddit")
    for r in rolling_average(rates, "posted_in_subreddit").collect():
        near = [per_minute.get((r.posted_in_subreddit, r.minute_start - timedelta(minutes=m))) for m in range(5)]
        assert r.rolling_avg == pytest.approx(statistics.mean(n for n in near if n))


def python_words(text):
    return re.split(r"[ \t\n\x0b\f\r]+", re.sub(r"[!-/:-@\[-`{-~]", " ", text.lower()))


ALPHABET = "abcXYZ éÈ،“”'’!?_-/\\\t\n  علي09{}[]$^.|"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=40))
def test_text_functions(spark, texts):
    df = spark.createDataFrame([(t, t[::-1]) for t in texts], "title string, content string")
    both = [F.col("title"), F.col("content")]
    for row in df.select("*", words(*both).alias("words"), prompt_text(*both).alias("prompt")).collect():
        assert row.words == python_words(f"{row.title} {row.content}")
        assert row.prompt == f"{row.title}\n\n{row.content}".strip()


def test_trending_words(spark):
    rng = random.Random(3)
    vocabulary = [*STOP_WORDS[:8], "alpha", "beta", "gamma", "abc", "Delta!"]
    posts = [
        (T0 + timedelta(seconds=rng.randrange(200)), " ".join(rng.choices(vocabulary, k=5)), None)
        for _ in range(300)
    ]
    expected = defaultdict(int)
    for when, title, _ in posts:
        for word in python_words(title):
            if len(word) > 3 and word not in STOP_WORDS:
                slice_start = (when - T0).seconds // 15 * 15
                for start in (slice_start, slice_start - 15):
                    expected[T0 + timedelta(seconds=start), word] += 1
    df = spark.createDataFrame(posts, "timestamp timestamp, title string, content string")
    got = {(r.window_start, r.word): r["count"] for r in trending_words(df).collect()}
    assert got == expected
