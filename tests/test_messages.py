import json
from datetime import datetime

from support import plan_text, rows
from pyspark.sql import functions as F

from chatterloom.functions.text import prompt_text
from chatterloom.operators.decode import decode, decode_tolerant
from chatterloom.operators.flatten import flatten_enriched, flatten_raw, to_lake_rows, to_messages
from chatterloom.operators.validate import split_valid, with_quality_flags, with_violations
from chatterloom.schemas import ENRICHED_EVENT, RAW_EVENT, ddl

GOOD = {
    "event_id": "e1",
    "event_type": "POST",
    "posted_in_subreddit": "g",
    "author": "a",
    "url": "u",
    "timestamp": "2024-01-01T00:00:15+00:00",
    "score": 5,
}
ENRICHED = {
    **GOOD,
    "enrichment": {
        "languages": ["en"],
        "sentiment_score": "0.5",
        "topics": ["x"],
        "entities": [{"name": "n", "type": "Person"}],
    },
}


def log(spark, *messages):
    text = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    return spark.createDataFrame(text, "payload string")


def reasons(spark, message, layout=RAW_EVENT):
    (row,) = with_violations(decode_tolerant(log(spark, message), layout)).collect()
    return row.violations


def test_strict_decode_nulls_what_does_not_fit(spark):
    df = flatten_raw(decode(log(spark, {**GOOD, "score": "5"}, "not json", "{}")))
    got = rows(df.select("event_id", "score"))
    assert got == [(None, None), (None, None), ("e1", None)]


def test_decode_reads_named_fields_only(spark):
    df = decode(log(spark, GOOD), RAW_EVENT, ["timestamp", "title"])
    assert df.schema["data"].dataType.names == ["timestamp", "title"]


def test_tolerant_numbers_times_and_flags(spark):
    messages = [
        {**GOOD, "event_id": "text", "score": "5", "has_media": "true"},
        {**GOOD, "event_id": "float", "score": 5.0, "timestamp": 1704067215},
        {**GOOD, "event_id": "millis", "timestamp": "1704067215000"},
        {**GOOD, "event_id": "day", "timestamp": "2024-01-01"},
    ]
    usable, rejected = split_valid(decode_tolerant(log(spark, *messages)))
    assert rejected.count() == 0
    got = {r.event_id: r for r in usable.collect()}
    assert got["text"].score == got["float"].score == 5 and got["text"].has_media is True
    assert got["float"].timestamp == got["millis"].timestamp == datetime(2024, 1, 1, 0, 0, 15)
    assert got["day"].timestamp == datetime(2024, 1, 1)


def test_left_out_fields_have_defaults(spark):
    usable, _ = split_valid(decode_tolerant(log(spark, GOOD)))
    row = usable.first()
    assert (row.has_media, row.media_urls, row.is_crosspost) == (False, [], False)
    assert row.score == 5 and row.title is None and row.num_comments is None
    assert reasons(spark, {**GOOD, "has_media": "maybe"}) == ["has_media:type"]


def test_each_rule_names_itself(spark):
    assert reasons(spark, GOOD) == []
    assert reasons(spark, "not json") == ["corrupt"]
    assert reasons(spark, "{}") == [
        f"{n}:missing"
        for n in ("event_id", "event_type", "posted_in_subreddit", "author", "url", "timestamp")
    ]
    assert reasons(spark, {**GOOD, "event_id": ""}) == ["event_id:missing"]
    assert reasons(spark, {**GOOD, "event_type": "LINK"}) == ["event_type:unknown"]
    assert reasons(spark, {**GOOD, "timestamp": "bad"}) == ["timestamp:missing", "timestamp:type"]
    assert reasons(spark, {**GOOD, "score": 5.5}) == ["score:type"]
    assert reasons(spark, {**GOOD, "media_urls": "x"}) == ["corrupt"]


def test_enrichment_rules(spark):
    assert reasons(spark, ENRICHED, ENRICHED_EVENT) == []
    assert reasons(spark, {**GOOD, "enrichment": None}, ENRICHED_EVENT) == []
    unknown = {**GOOD, "enrichment": {"languages": ["en", "xx"]}}
    assert reasons(spark, unknown, ENRICHED_EVENT) == ["enrichment.languages:unknown"]
    worded = {**GOOD, "enrichment": {"sentiment_score": "high"}}
    assert reasons(spark, worded, ENRICHED_EVENT) == ["enrichment.sentiment_score:type"]


def test_quarantine_keeps_the_payload_and_loses_nothing(spark):
    messages = [GOOD, "not json", {}, {**GOOD, "event_type": "LINK"}]
    usable, rejected = split_valid(decode_tolerant(log(spark, *messages)))
    assert usable.count() == 1 and usable.columns == list(RAW_EVENT)
    assert {r.payload for r in rejected.collect()} == {
        "not json",
        "{}",
        json.dumps({**GOOD, "event_type": "LINK"}),
    }


def test_messages_are_parsed_once(spark):
    usable, _ = split_valid(decode_tolerant(log(spark, GOOD, "x")))
    assert plan_text(usable, "simple").count("from_json") == 1


def test_quality_flags(spark):
    base = {"languages": ["en"], "intent": "question", "topics": ["a", "b"], "entities": []}
    doubtful = {
        "languages": ["xx"],
        "sentiment_score": 1.5,
        "intent": "testing",
        "topics": ["a"],
        "entities": [{"name": "n", "type": "Thing"}],
    }
    messages = [
        {**GOOD, "event_id": "a", "enrichment": {**base, "sentiment_score": -1.0}},
        {**GOOD, "event_id": "b", "enrichment": doubtful},
        {**GOOD, "event_id": "c", "enrichment": None},
    ]
    events = decode(log(spark, *messages), ENRICHED_EVENT).select("data.*")
    got = dict(rows(with_quality_flags(events).select("event_id", "quality_flags"), "event_id"))
    assert got == {
        "a": [],
        "b": ["languages", "sentiment_score", "intent", "topics", "entities"],
        "c": [],
    }


def test_message_round_trip_keeps_nulls_and_micros(spark):
    row = ("e", "POST", "g", "a", "u", None, 'q"\n', datetime(2024, 1, 1, 1, 2, 3, 456789), True, ["m"])
    row += (None, 0.1, 3, False, None)
    events = spark.createDataFrame([row], ddl(RAW_EVENT))
    (message,) = to_messages(events, key="event_id").collect()
    body = json.loads(message.value)
    assert message.key == "e" and list(body) == list(RAW_EVENT)
    assert body["title"] is None and body["timestamp"] == "2024-01-01T01:02:03.456789Z"
    back = flatten_raw(decode(log(spark, message.value)))
    assert rows(back) == rows(events)
    assert to_messages(events).first().key is None


def test_flat_enriched_and_lake_layouts(spark):
    events = decode(log(spark, {**GOOD, "enrichment": {"topics": ["x"]}}, GOOD), ENRICHED_EVENT)
    flat = {r.topics and "rich": r for r in flatten_enriched(events).collect()}
    assert flat["rich"].topics == ["x"] and flat["rich"].entities is None
    assert flat[None].languages is None
    named = decode(log(spark, ENRICHED), ENRICHED_EVENT)
    assert flatten_enriched(named).first().entities == '[{"name":"n","type":"Person"}]'
    lake = to_lake_rows(events.select("data.*")).collect()
    assert len(lake) == 1
    assert lake[0].enrichment_languages == lake[0].enrichment_entity_names == []
    stored = to_lake_rows(named.select("data.*")).first()
    assert (stored.enrichment_entity_names, stored.enrichment_entity_types) == (["n"], ["Person"])
    assert dict(to_lake_rows(events.select("data.*")).dtypes)["enrichment_sentiment"] == "double"
    assert F.col is not None


def test_a_value_is_cast_once(spark):
    """For itself and for the check of it; dates are not tried as numbers first, and prompts are not searched for edges."""
    log = spark.createDataFrame([("{}",)], "payload string")
    plan = plan_text(decode_tolerant(log, RAW_EVENT), "simple")
    assert plan.count("RLIKE") == 1 and plan.index("RLIKE") < plan.index("as double")
    edges = "".join(c for c in map(chr, range(0x11000)) if c.isspace())
    texts = [f"{edges}a{edges}b{edges}", edges, "", "a\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", prompt_text(F.lit(None), F.col("t")).alias("p"))
    assert dict(map(tuple, frame.collect())) == {t: t.strip() for t in texts}
    assert "regexp" not in plan_text(frame, "simple")
