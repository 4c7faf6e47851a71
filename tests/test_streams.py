import json
import os
import sys
import time
from datetime import date, datetime, timedelta, timezone

import pytest
from support import SMALL, rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from chatterloom.operators.decode import decode
from chatterloom.operators.enrich import provider_factory
from chatterloom.operators.trending import drop_redelivered, trending_words
from chatterloom.schemas import ENRICHED_EVENT, RAW_EVENT, TABLES
from chatterloom.session import kept_for_replay
from chatterloom.sinks.ageing import drop_chunks_before, drop_days_before
from chatterloom.sinks.lake import compact_lake, write_lake
from chatterloom.sinks.logs import publish, publish_batch
from chatterloom.sinks.tables import append_table, insert_ignore, read_table, replace_table
from chatterloom.sources.lake import read_lake
from chatterloom.sources.listings import read_listings
from chatterloom.sources.logs import read_log
from chatterloom.streaming import queries as streams
from chatterloom.streaming.control import (
    active_queries,
    checkpoint_path,
    late_rows_dropped,
    run_for,
    stop_all,
    trigger,
    watch_late_rows,
)
from workload import frames
from workload import queries as workload

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DRAIN = trigger(once=True)
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(event_id, seconds=0, **changes):
    return {
        "event_id": event_id,
        "event_type": "POST",
        "posted_in_subreddit": "g",
        "author": "a",
        "url": "u",
        "title": "hello",
        "timestamp": (T0 + timedelta(seconds=seconds)).isoformat(),
        **changes,
    }


_clock = [time.time() - 10_000]


def land(folder, *messages):
    """One log file; files get increasing times, so streams read them in order."""
    os.makedirs(folder, exist_ok=True)
    name = f"{folder}/{len(os.listdir(folder)):04d}.json"
    with open(name, "w") as out:
        out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
    _clock[0] += 10
    os.utime(name, (_clock[0], _clock[0]))


def text_log(spark, folder, **options):
    return read_log(spark, folder, format="text", options=options)


def read_json(spark, folder):
    return spark.read.option("recursiveFileLookup", "true").json(folder)


def at(seconds):
    return datetime(2024, 1, 1) + timedelta(seconds=seconds)


def test_stream_equals_batch_on_closed_windows(spark, path):
    publish(frames.document_events(spark, SMALL), path("log"), format="text")
    run_for(streams.save_trending_words(text_log(spark, path("log")), path("t"), path("c"), trigger=DRAIN))
    events = frames.documents(spark, SMALL)
    last = events.agg(F.max("timestamp")).first()[0]
    batch = trending_words(events).filter(F.col("window_end") <= last - timedelta(seconds=30))
    stream = read_table(spark, TABLES["trending_words_metrics"], path("t")).drop("chunk_start")
    assert stream.count() > 0
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_streams_of_the_workload_take_several_batches(spark, path):
    events = frames.document_events(spark, SMALL)
    log = workload._timed_log(spark, events)
    query = streams.save_tumbling_counts(log, path("t"), path("c"), trigger=DRAIN)
    run_for(query)
    with_rows = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(with_rows) == workload.SLICES and sum(p["numInputRows"] for p in with_rows) == events.count()


def test_files_of_a_log_grow_in_number_and_not_in_length(spark, path, monkeypatch):
    """Copies of an event come with it; the number of micro-batches stays."""
    monkeypatch.setattr(workload, "scratch_path", lambda _, name: path(name))
    monkeypatch.setattr(workload, "FILE_ROWS", 20)
    events = frames.document_events(spark, SMALL)
    log = workload._timed_log(spark, events, copies=2)
    query = streams.save_tumbling_counts(log, path("t"), path("c"), trigger=DRAIN)
    run_for(query)
    written = [name for name in os.listdir(path("log")) if name.startswith("part-")]
    n = 2 * events.count()
    assert len(written) == workload.SLICES * workload._files(n) > workload.SLICES * workload.FILES
    with_rows = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(with_rows) == workload.SLICES and sum(p["numInputRows"] for p in with_rows) == n


def test_replies_are_kept_small(spark, path):
    kept_for_replay(spark.createDataFrame([(1,)], "n int"), path("r"), 0)
    files = [name for name in os.listdir(path("r/batch_id=0")) if name.startswith("part-")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_late_rows(spark, path):
    """Lateness is judged by the watermark of the batch before."""
    land(path("log"), message("a", 0))
    land(path("log"), message("b", 600))
    land(path("log"), message("late", 1))
    land(path("log"), message("later", 2))
    log = text_log(spark, path("log"), maxFilesPerTrigger="1")
    counter = watch_late_rows(spark)
    query = streams.save_trending_words(log, path("t"), path("c"), trigger=DRAIN)
    run_for(query)
    table = read_table(spark, TABLES["trending_words_metrics"], path("t"))
    first = dict(rows(table.filter(F.col("window_start") == at(0)).select("word", "count")))
    dropped = late_rows_dropped(query, counter)
    spark.streams.removeListener(counter)
    assert first == {"hello": 2} and dropped == 2


def test_state_of_trending_words_grows_with_texts_and_not_with_words(spark, path):
    """A window's texts are a row of state each, equal ones one together; counts and late rows are as before."""
    many = " ".join(f"word{n} again" for n in range(50))
    for _ in range(2):
        land(path("log"), message("a", 5, content=many), message("b", 6, content=many), message("c", 7, content="Hello, HELLO there"))
    land(path("log"), message("d", 600), message("e", 601, title=None, content="the and"), message("f", timestamp=None))
    land(path("log"), message("g", 602))
    land(path("log"), message("late", 8, content=many))
    query = streams.save_trending_words(text_log(spark, path("log"), maxFilesPerTrigger="1"), path("t"), path("c"), trigger=DRAIN)
    run_for(query)
    updated = [sum(o["numRowsUpdated"] for o in p["stateOperators"]) for p in query.recentProgress if p["numInputRows"]]
    assert updated == [4, 4, 2, 2, 0]  # two texts, then one, in two windows each
    table = read_table(spark, TABLES["trending_words_metrics"], path("t"))
    for start in (-15, 0):
        found = dict(rows(table.filter(F.col("window_start") == at(start)).select("word", "count")))
        assert found == {"hello": 10, "again": 200, **{f"word{n}": 4 for n in range(50)}}
    assert table.count() == 2 * 52
    assert not table.groupBy("window_start", "word").count().filter("count > 1").count()


def test_replies_outlive_their_batch_until_the_next_begins(spark, path):
    first = spark.createDataFrame([(1,)], "n int")
    assert rows(kept_for_replay(first, path("r"), 0)) == [(1,)]
    # A replay after a crash finds the same replies, whatever would be answered now.
    assert rows(kept_for_replay(spark.createDataFrame([(2,)], "n int"), path("r"), 0)) == [(1,)]
    kept_for_replay(first, path("r"), 1)
    assert os.listdir(path("r")) == ["batch_id=1"]


def test_redelivered_events_can_be_dropped(spark, path):
    land(path("log"), message("a", 0), message("a", 0), message("b", 1))
    land(path("log"), message("a", 0), message("z", 300))
    log = text_log(spark, path("log"), maxFilesPerTrigger="1")
    events = decode(log, RAW_EVENT, ["event_id", "timestamp", "title"]).select("data.*")
    query = (
        drop_redelivered(events)
        .writeStream.format("parquet")
        .option("checkpointLocation", path("c"))
        .trigger(**DRAIN)
        .start(path("out"))
    )
    run_for(query)
    assert rows(spark.read.parquet(path("out")).select("event_id")) == [("a",), ("b",), ("z",)]


def test_replay_leaves_the_table_unchanged(spark, path):
    land(path("log"), message("a"), message("a"), message("b", 1), "not json", {"event_id": "c"})
    table = TABLES["raw_events"]
    for checkpoint in ("c1", "c2"):
        run_for(streams.save_raw(text_log(spark, path("log")), path("t"), path(checkpoint), trigger=DRAIN, quarantine=path("bad")))
        stored = read_table(spark, table, path("t"))
        assert rows(stored.select("event_id")) == [("a",), ("b",)]
    land(path("log"), message("a"), message("d", 2))
    run_for(streams.save_raw(text_log(spark, path("log")), path("t"), path("c2"), trigger=DRAIN, quarantine=path("bad")))
    assert rows(read_table(spark, table, path("t")).select("event_id")) == [("a",), ("b",), ("d",)]


def test_messages_without_key_are_quarantined(spark, path):
    land(path("log"), message("a"), "junk", {"event_id": "b"}, message("c", timestamp="never"))
    log = text_log(spark, path("log"))
    counts = []
    query = streams.save_raw(
        log, path("t"), path("c"), trigger=DRAIN, quarantine=path("bad"), report=counts.append
    )
    run_for(query)
    assert rows(read_table(spark, TABLES["raw_events"], path("t")).select("event_id")) == [("a",)]
    bad = read_json(spark, path("bad"))
    assert sorted((r.payload, r.reasons) for r in bad.collect() if r.payload == "junk") == [
        ("junk", ["event_id:missing", "timestamp:missing"])
    ]
    assert bad.count() == 3 and counts == [{"batch": 0, "quarantined": 3, "events": 1}]
    # Another stream with a checkpoint of its own adds to the folder.
    land(path("log2"), "other")
    query = streams.save_enriched(
        text_log(spark, path("log2")), path("t2"), path("c2"), trigger=DRAIN, quarantine=path("bad")
    )
    run_for(query)
    assert {"junk", "other"} <= {r.payload for r in read_json(spark, path("bad")).collect()}
    with pytest.raises(ValueError, match="target each"):
        streams.save_raw(log, path("t"), path("c3"), trigger=DRAIN, quarantine=path("t"))


def test_cap_counts_what_earlier_batches_stored(spark, path):
    """Windows of a minute, three events each; the last one crosses a chunk border."""
    border = 7 * 86400
    land(path("log"), *[message(f"a{i}", i) for i in (5, 3)], *[message(f"b{i}", 60 + i) for i in range(5)])
    land(path("log"), message("a3", 3), *[message(f"a{i}", i) for i in (59, 58, 57)])
    land(path("log"), message("a1", 1), *[message(f"c{i}", border - 1 + i) for i in range(5)])
    for checkpoint in ("c1", "c2"):
        log = text_log(spark, path("log"), maxFilesPerTrigger="1")
        counts = []
        query = streams.save_raw_capped(
            log,
            path("t"),
            path(checkpoint),
            trigger=DRAIN,
            per_window=3,
            quarantine=path("bad"),
            overflow=path("over"),
            report=counts.append,
        )
        run_for(query)
        stored = rows(read_table(spark, TABLES["raw_events"], path("t")).select("event_id"))
        assert [r[0] for r in stored] == ["a3", "a5", "a57", "b0", "b1", "b2", "c0", "c1", "c2", "c3"]
        assert len(counts) == 3
    over = {r.event_id for r in read_json(spark, path("over")).collect()}
    assert over == {"b3", "b4", "a58", "a59", "a1", "c4"}


def test_save_enriched_flattens(spark, path):
    land(path("log"), message("a", enrichment={"topics": ["x"], "entities": [{"name": "n", "type": "t"}]}))
    log = text_log(spark, path("log"))
    run_for(streams.save_enriched(log, path("t"), path("c"), trigger=DRAIN, quarantine=path("bad")))
    (row,) = read_table(spark, TABLES["enriched_events"], path("t")).collect()
    assert row.topics == ["x"] and row.entities == '[{"name":"n","type":"t"}]'


class Moody:
    def enrich(self, texts):
        return [None if "fail" in t else {"languages": ["en"], "sentiment_score": 0.5} for t in texts]


def test_enrichment_routes_every_message(spark, path):
    land(path("log"), message("a"), message("b", title="fail"), "junk", {"x": 1}, message("c", event_type="X"))
    outputs = streams.Outputs(path("ok"), path("dlq"), path("bad"), format="text")
    counts = []
    query = streams.enrich_log(
        text_log(spark, path("log")), Moody, outputs, path("c"), trigger=DRAIN, report=counts.append
    )
    run_for(query)
    assert counts == [{"batch": 0, "enriched": 1, "failed": 1, "quarantined": 3}]
    good = decode(read_log(spark, path("ok"), format="text", streaming=False), ENRICHED_EVENT)
    assert good.first().data.enrichment.sentiment_score == 0.5
    dead = read_log(spark, path("dlq"), format="text", streaming=False)
    (dead,) = [json.loads(r.payload) for r in dead.collect()]
    assert dead["event_id"] == "b" and dead["enrichment"] is None
    assert read_json(spark, path("bad")).count() == 3
    assert len(os.listdir(path("c") + "/replies")) <= 1  # those of the last batch, until the next begins


def test_outputs_need_targets_of_their_own():
    with pytest.raises(ValueError, match="dead_letter"):
        streams.Outputs("a", None, "b", format="text")
    with pytest.raises(ValueError, match="target each"):
        streams.Outputs("a", "b", "b/", format="text")


def test_a_replayed_batch_adds_nothing(spark, path):
    df = spark.createDataFrame([("a",), ("b",)], "event_id string")
    for query in ("q1", "q1", "q2"):
        assert publish_batch(df, path("log"), query, 0, format="text") == 2
        files = set(spark.read.option("recursiveFileLookup", "true").text(path("log")).inputFiles())
        if query == "q1":
            first = files
    assert first < files
    assert read_log(spark, path("log"), format="text", streaming=False).count() == 4


def test_listing_to_lake(spark, path, tmp_path):
    folder = tmp_path / "pages" / "endpoint=new"
    folder.mkdir(parents=True)
    items = [
        {"data": {"name": f"t3_{d}", "created_utc": 1704067200 + 86400 * d, "url": f"{d}.jpg", "post_hint": "image"}}
        for d in range(2)
    ]
    (folder / "1.json").write_text(json.dumps({"data": {"children": items}}))
    counts = []
    pages = read_listings(spark, path("pages"), streaming=True)
    query = streams.ingest_listings(
        pages, path("raw"), path("c1"), trigger=DRAIN, format="text", quarantine=path("odd"), report=counts.append
    )
    run_for(query)
    assert counts == [{"batch": 0, "sent": 2, "quarantined": 0, "with_media": 2}]
    # A second run with a new checkpoint adds to the log.
    items[0]["data"]["name"] = "t3_9"
    (folder / "1.json").write_text(json.dumps({"data": {"children": items[:1]}}))
    pages = read_listings(spark, path("pages"), streaming=True)
    run_for(streams.ingest_listings(pages, path("raw"), path("c9"), trigger=DRAIN, format="text", quarantine=path("odd")))
    assert {r.event_id for r in read_json(spark, path("raw")).collect()} == {"t3_0", "t3_1", "t3_9"}
    outputs = streams.Outputs(path("ok"), path("dlq"), path("bad"), format="text")
    log = text_log(spark, path("raw"))
    run_for(streams.enrich_log(log, provider_factory("dummy"), outputs, path("c2"), trigger=DRAIN))
    log = text_log(spark, path("ok"))
    run_for(streams.store_log(log, path("lake"), path("c3"), trigger=DRAIN))
    stored = rows(read_lake(spark, path("lake")).select("event_id", "day", "media_urls", "enrichment_intent"))
    assert stored == [
        ("t3_0", 1, ["0.jpg"], "testing"),
        ("t3_1", 2, ["1.jpg"], "testing"),
        ("t3_9", 1, ["0.jpg"], "testing"),
    ]


def test_only_valid_enriched_events_reach_the_lake(spark, path):
    good = {"languages": ["en"]}
    land(
        path("log"),
        message("a", enrichment=good),
        message("b", enrichment=None),
        message("c", enrichment={"languages": ["xx"]}),
        message("", enrichment=good),
        "junk",
    )
    run_for(streams.store_log(text_log(spark, path("log")), path("lake"), path("c"), trigger=DRAIN))
    assert rows(read_lake(spark, path("lake")).select("event_id")) == [("a",)]
    run_for(streams.quarantine_log(text_log(spark, path("log")), path("bad"), path("c2"), trigger=DRAIN))
    reasons = {tuple(r.reasons) for r in spark.read.json(path("bad")).collect()}
    assert reasons == {("enrichment.languages:unknown",), ("event_id:missing",), ("corrupt",)}
    with pytest.raises(ValueError, match="stream"):
        write_lake(read_lake(spark, path("lake")), path("lake"))
    with pytest.raises(ValueError, match="stream"):
        drop_days_before(spark, path("lake"), 1, date(2030, 1, 1))
    compact_lake(spark, path("lake"), path("archive"))
    compact_lake(spark, path("lake"), path("archive"))
    assert rows(read_lake(spark, path("archive")).select("event_id")) == [("a",)]
    assert drop_days_before(spark, path("archive"), 1, date(2030, 1, 1)) == [date(2024, 1, 1)]


def test_streamed_lake_gets_few_files(spark, path):
    events = [message(str(i), 3600 * i, enrichment={"languages": ["en"]}) for i in range(48)]
    for i in range(0, 48, 8):
        land(path("log"), *events[i : i + 8])
    run_for(streams.store_log(text_log(spark, path("log")), path("lake"), path("c"), trigger=DRAIN))
    lake = read_lake(spark, path("lake"))
    assert lake.count() == 48 and len(lake.inputFiles()) == 2


def test_bounded_run_list_and_stop(spark, path):
    land(path("log"), message("a"))
    log = text_log(spark, path("log"))
    query = streams.save_raw(log, path("t"), path("c"), trigger=trigger(seconds=1), quarantine=path("bad"))
    assert (str(query.id), "raw_events") in active_queries(spark)
    began = time.time()
    assert run_for(query, 3) is False
    assert time.time() - began < 60 and not query.isActive
    other = streams.save_raw(log, path("t2"), path("c2"), trigger=trigger(), quarantine=path("bad"))
    assert stop_all(spark) == 1 and not other.isActive and active_queries(spark) == []
    assert trigger() == {"processingTime": "120 seconds"}
    assert checkpoint_path("/x/", "t", "j") == "/x/t/j"


def test_sink_failures_are_raised(spark, path):
    land(path("log"), message("a"))
    blocked = path("file")
    open(blocked, "w").close()
    log = text_log(spark, path("log"))
    query = streams.save_raw(log, f"{blocked}/t", path("c"), trigger=DRAIN, quarantine=path("bad"))
    with pytest.raises(Exception):
        run_for(query)


def _events(spark, *pairs):
    full = [json.dumps(message(i, s)) for i, s in pairs]
    log = spark.createDataFrame([(m,) for m in full], "payload string")
    return decode(log, RAW_EVENT).select("data.*")


def test_table_writes(spark, path):
    table, week = TABLES["raw_events"], 7 * 86400
    replace_table(_events(spark, ("a", 0), ("b", week)), table, path("t"))
    append_table(_events(spark, ("a", 0)), table, path("t"))
    ids = lambda: rows(read_table(spark, table, path("t")).select("event_id"))
    assert ids() == [("a",), ("a",), ("b",)]
    insert_ignore(_events(spark, ("a", 0), ("a", 1), ("c", week), ("c", week)), table, path("t"))
    assert ids() == [("a",), ("a",), ("a",), ("b",), ("c",)]
    insert_ignore(_events(spark, ("a", 0)).filter("false"), table, path("t"))
    replace_table(_events(spark, ("n", week)), table, path("t"), whole=False)
    assert ids() == [("a",), ("a",), ("a",), ("n",)]
    assert drop_chunks_before(spark, path("t"), 3, date(2024, 1, 12)) == [date(2024, 1, 1)]
    assert ids() == [("n",)]
    replace_table(_events(spark, ("z", 0)), table, path("t"))
    assert ids() == [("z",)]


def test_bounded_snapshot_clears_stale_chunks(spark, path):
    table, week = TABLES["raw_events"], 7 * 86400
    replace_table(_events(spark, ("a", 0), ("b", week), ("c", 2 * week)), table, path("t"))
    span = (date(2024, 1, 1), date(2024, 1, 15))
    replace_table(_events(spark, ("n", 0)), table, path("t"), whole=False, span=span)
    assert rows(read_table(spark, table, path("t")).select("event_id")) == [("c",), ("n",)]


def test_copies_in_a_batch_leave_the_same_row(spark, path):
    copies = [message("a", 0, score=s) for s in (3, 9, 5)]
    log = spark.createDataFrame([(json.dumps(m),) for m in copies], "payload string")
    for n in range(2):
        batch = decode(log, RAW_EVENT).select("data.*").repartition(n + 1)
        insert_ignore(batch, TABLES["raw_events"], path(f"t{n}"))
        assert rows(read_table(spark, TABLES["raw_events"], path(f"t{n}")).select("score")) == [(9,)]


def test_rows_without_time_are_refused(spark, path):
    timeless = _events(spark, ("a", 0)).withColumn("timestamp", F.lit(None).cast("timestamp"))
    with pytest.raises(ValueError, match="timestamp"):
        insert_ignore(timeless, TABLES["raw_events"], path("t"))


def test_merge_over_very_many_chunks(spark, path):
    table, week = TABLES["raw_events"], 7 * 86400
    many = [(str(i), i * week) for i in range(230)]
    insert_ignore(_events(spark, *many), table, path("t"))
    insert_ignore(_events(spark, *many, ("new", 0)), table, path("t"))
    assert read_table(spark, table, path("t")).count() == 231
