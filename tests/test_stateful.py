"""Keyed state and timers: caps, late rows, retries, rates, and streams that are awaited together."""

import json
import os
import sys
import time
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from support import SMALL, rows

from chatterloom.operators.rates import event_rate, live_rates, rolling_average
from chatterloom.operators.decode import decode
from chatterloom.schemas import RAW_EVENT, TABLES
from chatterloom.sinks.tables import read_table
from chatterloom.sources.logs import read_log
from chatterloom.streaming import queries as streams
from chatterloom.streaming.control import run_for, run_together, trigger
from workload import frames
from workload.providers import StepProvider

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DRAIN = trigger(once=True)
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
_clock = [time.time() - 10_000]


def message(event_id, seconds=0, **changes):
    return {
        "event_id": event_id, "event_type": "POST", "posted_in_subreddit": "g", "author": "a", "url": "u",
        "title": "hello", "timestamp": (T0 + timedelta(seconds=seconds)).isoformat(), **changes,
    }


def land(folder, *messages):
    os.makedirs(folder, exist_ok=True)
    name = f"{folder}/{len(os.listdir(folder)):04d}.json"
    with open(name, "w") as out:
        out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
    _clock[0] += 10
    os.utime(name, (_clock[0], _clock[0]))


def file_by_file(spark, folder):
    return read_log(spark, folder, format="text", options={"maxFilesPerTrigger": "1"})


def event_ids(spark, folder):
    if not os.path.exists(folder):
        return []
    read = decode(read_log(spark, folder, format="text", streaming=False), RAW_EVENT, ["event_id"])
    return sorted(r[0] for r in read.select("data.event_id").collect())


def capped(spark, path, **options):
    given = {"per_window": 2, "window_seconds": 60, "grace": "30 seconds", **options}
    query = streams.save_raw_capped_by_state(
        file_by_file(spark, path("log")), path("t"), path("c"), trigger=DRAIN, quarantine=path("bad"), overflow=path("over"), **given
    )
    run_for(query)
    kept = sorted(r[0] for r in read_table(spark, TABLES["raw_events"], path("t")).select("event_id").collect())
    return query, kept


def test_a_window_takes_its_first_events(spark, path):
    land(path("log"), message("c", 3), message("a", 1), message("b", 2), message("other", 70), "no json", message(None, 5))
    land(path("log"), message("a", 1), message("early", 0), message("again", 71), message("third", 72))
    query, kept = capped(spark, path)
    # The first batch fills the window, so what comes before its events later is over the cap; copies are not counted.
    assert kept == ["a", "again", "b", "other"]
    assert event_ids(spark, path("over")) == ["c", "early", "third"]
    bad = spark.read.option("recursiveFileLookup", "true").json(path("bad"))
    assert bad.count() == 2


def test_state_goes_with_its_window_and_late_events_are_kept(spark, path):
    land(path("log"), message("a", 0), message("b", 1))
    land(path("log"), message("far", 600))
    land(path("log"), message("late", 2), message("far2", 601))
    query, kept = capped(spark, path)
    assert kept == ["a", "b", "far", "far2"] and event_ids(spark, path("over")) == ["late"]
    state = spark.read.format("statestore").option("stateVarName", "admitted").load(path("c"))
    held = {r.key[0] for r in state.select("key").collect()}
    assert held == {int((T0 + timedelta(seconds=600)).timestamp()) * 1_000_000}


def test_a_hot_window_is_thinned_before_the_shuffle(spark, path):
    land(path("log"), *[message(f"e{i:05d}", i % 50) for i in range(3000)])
    query, kept = capped(spark, path, per_window=3)
    assert kept == ["e00000", "e00050", "e00100"] and len(event_ids(spark, path("over"))) == 2997


def test_a_cap_goes_on_after_a_restart(spark, path):
    land(path("log"), message("a", 0))
    capped(spark, path)
    land(path("log"), message("b", 1), message("c", 2), message("a", 0))
    _, kept = capped(spark, path)
    assert kept == ["a", "b"] and event_ids(spark, path("over")) == ["c"]


def test_every_event_is_counted_or_kept_as_late(spark, path):
    land(path("log"), message("a", 0), message("b", 59), message("c", 61), "no json")
    land(path("log"), message("d", 2), message("far", 600))
    land(path("log"), message("late", 3), message("later", 62), message("far2", 610))
    land(path("log"), message("end", 5000))
    heard = []
    query = streams.save_counts_and_late(
        file_by_file(spark, path("log")), path("t"), path("c"), trigger=DRAIN, late=path("late"), quarantine=path("bad"), report=heard.append
    )
    run_for(query)
    table = read_table(spark, TABLES["tumbling_counts_metrics"], path("t"))
    counts = {r.window_start.minute: r["count"] for r in table.collect()}
    assert counts == {0: 3, 1: 1, 10: 2}
    assert event_ids(spark, path("late")) == ["late", "later"]
    assert sum(h["late"] for h in heard) == 2 and sum(h["quarantined"] for h in heard) == 1


def test_live_rates_of_a_batch_are_rates_and_averages(spark):
    events = frames.raw_events(spark, SMALL).select("timestamp", F.col("posted_in_subreddit").alias("stream"))
    rates = event_rate(events)
    want = rates.join(rolling_average(rates), ["stream", "minute_start"]).select("stream", "minute_start", "events", "rolling_avg")
    found = live_rates(events, grace=None)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty() and not found.isEmpty()


def outputs(path):
    return streams.Outputs(path("ok"), path("dlq"), path("bad"), format="text")


def test_failed_events_are_asked_for_again(spark, path):
    # The prompt of an event is its title here; StepProvider answers lengths below its step by five.
    titles = {"x5": "aaaaa", "x6": "aaaaaa", "x8": "aaaaaaaa", "x9": "aaaaaaaaa"}
    land(path("dlq"), *[message(k, title=t) for k, t in titles.items()], message("x9", title="aaaaaaaaa"))
    heard = []
    for step in (1, 2, 2, 5):
        run_for(streams.retry_failed(
            file_by_file(spark, path("dlq")), lambda step=step: StepProvider(step), outputs(path), path("c"),
            trigger=DRAIN, final=path("final"), attempts=3, pause=0.0, report=heard.append,
        ))
    assert event_ids(spark, path("ok")) == ["x5", "x6"]
    assert event_ids(spark, path("final")) == ["x8", "x9"]


def test_a_pause_is_kept_and_doubles(spark, path):
    land(path("dlq"), message("x9", title="aaaaaaaaa"))
    heard = []
    query = streams.retry_failed(
        read_log(spark, path("dlq"), format="text"), lambda: StepProvider(1), outputs(path), path("c"), trigger=trigger(seconds=1),
        final=path("final"), attempts=2, pause=2.0, report=lambda c: heard.append((time.monotonic(), c)),
    )
    end = time.monotonic() + 90
    while not event_ids(spark, path("final")) and time.monotonic() < end:
        time.sleep(0.5)
    run_for(query, 0.1)
    tried = [t for t, c in heard if c["failed"] or c["given_up"]]
    assert event_ids(spark, path("final")) == ["x9"] and len(tried) == 2 and tried[1] - tried[0] >= 3.5


def test_a_pause_needs_a_query_that_goes_on(spark, path):
    with pytest.raises(ValueError, match="goes on"):
        streams.retry_failed(None, None, outputs(path), path("c"), trigger=DRAIN, final=path("final"))
    with pytest.raises(ValueError, match="target each"):
        streams.retry_failed(None, None, outputs(path), path("c"), trigger=DRAIN, final=path("dlq"), pause=0.0)


def test_a_failure_of_any_stream_ends_all(spark, path):
    os.makedirs(path("log"))
    log = file_by_file(spark, path("log"))
    ever = trigger(seconds=1)
    good = streams.quarantine_log(log, path("q"), path("c1"), trigger=ever)

    def fail(batch, batch_id):
        raise RuntimeError("this one fails")

    bad = log.writeStream.foreachBatch(fail).option("checkpointLocation", path("c2")).trigger(**ever).start()
    land(path("log"), "no json")
    begin = time.monotonic()
    with pytest.raises(Exception, match="this one fails"):
        run_together([good, bad], 120)
    assert not good.isActive and not bad.isActive and time.monotonic() - begin < 60


def test_the_time_limit_is_for_all_streams(spark, path):
    os.makedirs(path("log"))
    log = file_by_file(spark, path("log"))
    ever = trigger(seconds=1)
    other = log.writeStream.format("noop").option("checkpointLocation", path("c2")).trigger(**ever).start()
    queries = [streams.quarantine_log(log, path("q"), path("c"), trigger=ever), other]
    begin = time.monotonic()
    assert not run_together(queries, 4)
    assert time.monotonic() - begin < 15 and not any(q.isActive for q in queries)
    drained = streams.quarantine_log(log, path("q3"), path("c3"), trigger=DRAIN)
    assert run_together([drained], 60)


def test_only_dense_windows_are_spread():
    """A window of few rows is one key, so its state is asked once; rows without a time stay spread."""
    from chatterloom.streaming.stateful import FEW_ROWS, _gathered

    windows = [0] * (FEW_ROWS + 1) + [60] * FEW_ROWS + [None] * 3
    spread = [1 + n % 5 for n in range(len(windows))]
    columns = {"window": pa.array(windows, pa.int64()), "payload": [str(n) for n in range(len(windows))], "spread": pa.array(spread, pa.int32())}
    (out,) = _gathered(iter([pa.RecordBatch.from_pydict(columns)]))
    expected = [0 if w == 60 else s for w, s in zip(windows, spread, strict=True)]
    assert out.to_pydict() == {"window": windows, "payload": columns["payload"], "spread": expected}
