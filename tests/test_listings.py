import json
from datetime import datetime

from support import rows
from pyspark.sql import functions as F

from chatterloom.operators.cursor import (
    advance_marks,
    after_marks,
    high_water_marks,
    poll,
    read_marks,
    save_marks,
)
from chatterloom.operators.normalize import to_events
from chatterloom.operators.rates import media_counts
from chatterloom.sources.listings import items, read_listings, split_items


def land(root, endpoint, *children, name="page.json"):
    folder = root / f"endpoint={endpoint}"
    folder.mkdir(parents=True, exist_ok=True)
    page = {"data": {"children": [{"data": child} for child in children]}}
    (folder / name).write_text(json.dumps(page))


def events_of(spark, root):
    return {r.event_id: r for r in to_events(items(read_listings(spark, str(root)))).collect()}


def test_posts_and_comments(spark, tmp_path):
    land(
        tmp_path,
        "new",
        {
            "name": "t3_1",
            "id": "1",
            "subreddit": "g",
            "author": "x",
            "created_utc": 1704067215.0,
            "url": "u",
            "title": "t",
            "selftext": "s",
            "score": 3,
            "is_crosspost": True,
            "crosspost_parent_list": [{"subreddit": "first"}, {"subreddit": "second"}],
            "unknown_field": {"a": 1},
        },
        {"id": "2", "is_crosspost": True, "crosspost_parent_list": []},
        {"id": "3", "crosspost_parent_list": [{"subreddit": "first"}]},
    )
    land(tmp_path, "comments", {"name": "t1_1", "link_url": "lu", "link_title": "lt", "body": "b", "url": "no"}, {"name": "t1_2"})
    land(tmp_path, "about", {"name": "ignored"})
    got = events_of(spark, tmp_path)
    assert set(got) == {"t3_1", "2", "3", "t1_1", "t1_2"}
    post = got["t3_1"]
    assert (post.event_type, post.url, post.title, post.content) == ("POST", "u", "t", "s")
    assert post.timestamp == datetime(2024, 1, 1, 0, 0, 15)
    assert post.original_subreddit == "first" and post.is_crosspost
    assert (got["2"].author, got["2"].posted_in_subreddit, got["2"].url) == ("[deleted]", "", None)
    assert got["2"].original_subreddit is None and got["2"].timestamp == datetime(1970, 1, 1)
    assert got["3"].original_subreddit is None and got["3"].is_crosspost is False
    comment = got["t1_1"]
    assert (comment.event_type, comment.url, comment.title, comment.content) == ("COMMENT", "lu", "lt", "b")
    assert (got["t1_2"].url, got["t1_2"].title, got["t1_2"].content) == ("", "", "")


def _media(*links):
    return {str(i): {"s": link} for i, link in enumerate(links)}


def test_media_links(spark, tmp_path):
    video = {"reddit_video": {"fallback_url": "v.mp4"}}
    land(
        tmp_path,
        "new",
        {"id": "video", "is_video": True, "secure_media": video, "is_gallery": True},
        {"id": "lost video", "is_video": True, "url": "a.jpg", "post_hint": "image"},
        {"id": "gallery", "is_gallery": True, "media_metadata": _media({"u": "b?x=1&amp;y=2"}, {"gif": "g"}, {"u": "a&amp;"})},
        {"id": "empty gallery", "is_gallery": True, "post_hint": "image", "url": "a.jpg"},
        {"id": "image", "post_hint": "image", "url": "a.jpeg"},
        {"id": "link", "post_hint": "link", "url": "a.gif?x&amp;.png"},
        {"id": "upper", "post_hint": "image", "url": "a.JPG"},
        {"id": "self", "post_hint": "self", "url": "a.jpg"},
        {"id": "plain"},
    )
    land(tmp_path, "comments", {"id": "animated", "media_metadata": _media({"gif": "g&amp;h"}, {"u": "u", "gif": "g"}, {})}, {"id": "bare"})
    got = {k: r.media_urls for k, r in events_of(spark, tmp_path).items()}
    assert got == {
        "video": ["v.mp4"],
        "lost video": [],
        "gallery": ["b?x=1&y=2", "a&"],
        "empty gallery": [],
        "image": ["a.jpeg"],
        "link": ["a.gif?x&amp;.png"],
        "upper": [],
        "self": [],
        "plain": [],
        "animated": ["g&h", "u"],
        "bare": [],
    }
    assert all(r.has_media == bool(r.media_urls) for r in events_of(spark, tmp_path).values())


def test_media_counts(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", None)], "g string, has_media boolean")
    assert rows(media_counts(df, "g")) == [("a", 2, 1), ("b", 1, 0)]


def _events(spark, *triples):
    return spark.createDataFrame(
        [(g, datetime(2024, 1, 1, 0, minute), i) for g, minute, i in triples],
        "endpoint string, timestamp timestamp, event_id string",
    )


def test_cursor_returns_only_newer_events(spark):
    stored = _events(spark, ("new", 5, "b"), ("new", 5, "a"), ("new", 1, "z"))
    fetched = _events(
        spark, ("new", 5, "a"), ("new", 5, "b"), ("new", 5, "c"), ("new", 6, "a"), ("comments", 0, "q")
    )
    marks = high_water_marks(stored, "endpoint")
    fresh = after_marks(fetched, marks, "endpoint").select("endpoint", "event_id")
    assert rows(fresh) == [("comments", "q"), ("new", "a"), ("new", "c")]
    oldest = poll(fetched, marks, "endpoint", 1).select("endpoint", "event_id")
    assert rows(oldest) == [("comments", "q"), ("new", "c")]


def test_polls_lose_nothing_between_marks(spark):
    fetched = _events(spark, *[("new", m, f"{m:02d}") for m in range(7)], ("comments", 0, "q"))
    marks = high_water_marks(fetched.limit(0), "endpoint")
    seen = []
    for _ in range(4):
        taken = poll(fetched, marks, "endpoint", 2).cache()
        seen += [r.event_id for r in taken.filter("endpoint = 'new'").orderBy("timestamp").collect()]
        marks = advance_marks(marks, taken, "endpoint")
    assert seen == [f"{m:02d}" for m in range(7)]


def test_marks_are_stored(spark, path):
    marks = high_water_marks(_events(spark, ("new", 5, "b"), ("new", 1, "z")), "endpoint")
    for _ in range(2):
        save_marks(marks, path("marks"), 1)
    assert rows(read_marks(spark, path("marks"), 1).select("endpoint", "mark.event_id")) == [("new", "b")]


def test_damaged_pages_and_children_are_quarantined(spark, tmp_path):
    land(
        tmp_path,
        "new",
        {"name": "a", "score": "5", "created_utc": "1704067215", "is_crosspost": "true", "num_comments": 2.0},
        {"name": "b", "created_utc": "soon"},
        {"name": "c", "score": "many", "upvote_ratio": "much"},
        {"name": "d", "created_utc": "2024-01-01T00:00:15Z"},
        None,
    )
    land(tmp_path, "about", {"name": "x"})
    (tmp_path / "endpoint=new" / "broken.json").write_text("<html>\n")
    pages = read_listings(spark, str(tmp_path))
    got = events_of(spark, tmp_path)
    assert set(got) == {"a", "d"}
    assert (got["a"].score, got["a"].is_crosspost, got["a"].num_comments) == (5, True, 2)
    assert got["a"].timestamp == got["d"].timestamp == datetime(2024, 1, 1, 0, 0, 15)
    _, rejected = split_items(pages)
    assert sorted((r.endpoint, r.reasons) for r in rejected.collect()) == [
        ("about", ["page:endpoint"]),
        ("new", ["child:missing"]),
        ("new", ["created_utc:type"]),
        ("new", ["page:corrupt"]),
        ("new", ["score:type", "upvote_ratio:type"]),
    ]
    assert "<html>" in {r.payload for r in rejected.collect()}
