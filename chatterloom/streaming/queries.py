"""The pipeline's streaming queries, from log to table, lake or next log."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterloom.operators.decode import decode, decode_tolerant
from chatterloom.operators.enrich import Provider, enrich, split_enriched
from chatterloom.operators.flatten import flatten_enriched, flatten_raw, to_lake_rows
from chatterloom.operators.normalize import to_events
from chatterloom.operators.rates import live_rates
from chatterloom.operators.trending import (
    TUMBLING_GRACE,
    drop_redelivered,
    texts_per_window,
    trending_topics,
    tumbling_counts,
    within_cap,
    words_of_texts,
)
from chatterloom.operators.validate import split_checked, split_valid, with_violations
from chatterloom.schemas import ENRICHED_EVENT, RAW_EVENT, TABLES
from chatterloom.session import kept_for_replay
from chatterloom.sinks.lake import stream_to_lake
from chatterloom.sinks.logs import publish_batch, query_id
from chatterloom.sinks.tables import insert_ignore, insert_ignore_batches
from chatterloom.sources.listings import split_items
from chatterloom.streaming.stateful import capped, counted, due_again

Report = Callable[[dict[str, int]], None]
_log = logging.getLogger(__name__)


def _log_counts(counts: dict[str, int]) -> None:
    _log.info("%s", counts)


def stream_to_table(
    rows: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    **options: Any,
) -> StreamingQuery:
    """Streams rows into a result table; keys already there are left alone.

    ``options`` are those of ``insert_ignore``.
    """
    return (
        rows.writeStream.queryName(table)
        .outputMode("append")
        .foreachBatch(insert_ignore_batches(TABLES[table], path, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


# A message without these is no event of a table.
_KEY = ("event_id", "timestamp")


def _save_events(
    log: DataFrame,
    layout: Mapping[str, str],
    flatten: Callable[[DataFrame], DataFrame],
    table: str,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    quarantine: str,
    report: Report,
    overflow: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Streams the messages that have a key into a table of events.

    The others are no events; their payloads go to the ``quarantine`` folder
    with the reasons. ``report`` gets the counts of every batch.
    """
    _distinct({"table": path, "quarantine": quarantine, "overflow": overflow})
    missing = [F.when(F.col(f"data.{n}").isNull(), F.lit(f"{n}:missing")) for n in _KEY]
    usable = F.size("reasons") == 0

    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept parsed, with what is wrong: both outputs read it.
        decoded = decode(batch, layout, keep=["payload"])
        decoded = decoded.withColumn("reasons", F.array_compact(F.array(*missing))).persist()
        try:
            query = query_id(batch.sparkSession, checkpoint)
            to = {"query": query, "batch_id": batch_id, "format": "text"}
            rejected = decoded.filter(~usable).select("payload", "reasons")
            counts = {"batch": batch_id, "quarantined": publish_batch(rejected, quarantine, **to)}
            if overflow is not None:
                options["refused"] = lambda rows: counts.update(
                    over_cap=publish_batch(rows, overflow, **to)
                )
            events = flatten(decoded.filter(usable).select("data"))
            insert_ignore(events, TABLES[table], path, **options)
            counts["events"] = decoded.filter(usable).count()
        finally:
            decoded.unpersist()
        report(counts)

    return (
        log.writeStream.queryName(table)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def save_raw(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    quarantine: str,
    report: Report = _log_counts,
) -> StreamingQuery:
    return _save_events(
        log,
        RAW_EVENT,
        flatten_raw,
        "raw_events",
        path,
        checkpoint,
        trigger=trigger,
        quarantine=quarantine,
        report=report,
    )


def save_raw_capped(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    quarantine: str,
    overflow: str,
    per_window: int,
    window_seconds: int = 60,
    report: Report = _log_counts,
) -> StreamingQuery:
    """``save_raw`` that keeps the first ``per_window`` events of every window.

    What the table holds counts, so a window is never filled past the cap,
    however many batches bring its events. New events over the cap go to the
    ``overflow`` folder.
    """
    window = f"{window_seconds} seconds"
    return _save_events(
        log,
        RAW_EVENT,
        flatten_raw,
        "raw_events",
        path,
        checkpoint,
        trigger=trigger,
        quarantine=quarantine,
        report=report,
        overflow=overflow,
        admit=lambda new, kept: within_cap(new, kept, per_window, window=window),
        margin=timedelta(seconds=window_seconds),
    )


def save_raw_capped_by_state(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    quarantine: str,
    overflow: str,
    per_window: int,
    window_seconds: int = 60,
    grace: str = TUMBLING_GRACE,
    report: Report = _log_counts,
) -> StreamingQuery:
    """``save_raw_capped`` whose windows are counted in state instead of read back from the table.

    Events of a full window, and those that come when their window is over (``grace`` behind the newest), go to the
    ``overflow`` folder; an event that is delivered again after its window was full may go there once more.
    """
    _distinct({"table": path, "quarantine": quarantine, "overflow": overflow})

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = batch.persist()
        try:
            query = query_id(batch.sparkSession, checkpoint)
            to = {"query": query, "batch_id": batch_id, "format": "text"}

            def events(*verdicts: str) -> DataFrame:
                return flatten_raw(decode(judged.filter(F.col("verdict").isin(*verdicts)), RAW_EVENT))

            rejected = judged.filter("verdict = 'unkeyed'").select("payload", F.array(F.lit("key:missing")).alias("reasons"))
            counts = {"batch": batch_id, "quarantined": publish_batch(rejected, quarantine, **to)}
            counts["over_cap"] = publish_batch(events("over", "late"), overflow, **to)
            insert_ignore(events("kept"), TABLES["raw_events"], path)
            counts["events"] = judged.filter("verdict = 'kept'").count()
        finally:
            judged.unpersist()
        report(counts)

    return (
        capped(log, per_window, window_seconds=window_seconds, grace=grace)
        .writeStream.queryName("raw_events")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def save_enriched(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    quarantine: str,
    report: Report = _log_counts,
) -> StreamingQuery:
    return _save_events(
        log,
        ENRICHED_EVENT,
        flatten_enriched,
        "enriched_events",
        path,
        checkpoint,
        trigger=trigger,
        quarantine=quarantine,
        report=report,
    )


def save_trending_words(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    unique: bool = False,
    **windowing: str | None,
) -> StreamingQuery:
    """Counts words per window; ``unique`` counts a redelivered event once.

    The stream's state holds the texts of open windows; their words are counted when the watermark has passed a window.
    """
    wanted = ["event_id", "timestamp", "title", "content"]
    events = decode(log, RAW_EVENT, wanted if unique else wanted[1:]).select("data.*")
    if unique:
        events = drop_redelivered(events)
        windowing["watermark"] = None
    texts = texts_per_window(events, **windowing)
    return stream_to_table(
        texts, "trending_words_metrics", path, checkpoint, trigger=trigger, keys_unique=True, derive=words_of_texts
    )


def save_trending_topics(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    unique: bool = False,
    **windowing: str | None,
) -> StreamingQuery:
    """Counts topics per window; ``unique`` counts a redelivered event once."""
    wanted = {
        "event_id": "string",
        "timestamp": "timestamp",
        "enrichment": "struct<topics:array<string>>",
    }
    fields = list(wanted) if unique else ["timestamp", "enrichment"]
    events = decode(log, wanted, fields).select("data.*")
    if unique:
        events = drop_redelivered(events)
        windowing["watermark"] = None
    topics = events.select("timestamp", F.col("enrichment.topics").alias("topics"))
    counts = trending_topics(topics, **windowing)
    return stream_to_table(
        counts, "trending_topics_metrics", path, checkpoint, trigger=trigger, keys_unique=True
    )


def save_tumbling_counts(
    log: DataFrame, path: str, checkpoint: str, *, trigger: dict, **windowing: str | None
) -> StreamingQuery:
    """Counts events per tumbling window."""
    events = decode(log, RAW_EVENT, ["timestamp"]).select("data.*")
    counts = tumbling_counts(events, **windowing)
    return stream_to_table(
        counts, "tumbling_counts_metrics", path, checkpoint, trigger=trigger, keys_unique=True
    )


def save_counts_and_late(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    late: str,
    quarantine: str,
    window_seconds: int = 60,
    grace: str = TUMBLING_GRACE,
    report: Report = _log_counts,
) -> StreamingQuery:
    """Counts events per tumbling window and keeps the events that came too late to be counted.

    Every message goes to one place: into the count of a window once that is over, to the ``late`` folder as an event,
    or, without a time, to the ``quarantine`` folder. ``report`` gets the exact numbers of every batch.
    """
    _distinct({"table": path, "late": late, "quarantine": quarantine})

    def write(batch: DataFrame, batch_id: int) -> None:
        found = batch.persist()
        try:
            query = query_id(batch.sparkSession, checkpoint)
            to = {"query": query, "batch_id": batch_id, "format": "text"}
            messages = found.filter("payload is not null")
            untimed = messages.filter("window is null").select("payload", F.array(F.lit("timestamp:missing")).alias("reasons"))
            behind = flatten_raw(decode(messages.filter("window is not null"), RAW_EVENT))
            counts = {
                "batch": batch_id,
                "quarantined": publish_batch(untimed, quarantine, **to),
                "late": publish_batch(behind, late, **to),
            }
            edges = [F.timestamp_micros(F.col("window") + x).alias(n) for n, x in (("window_start", 0), ("window_end", window_seconds * 1_000_000))]
            closed = found.filter("n is not null").groupBy("window").agg(F.sum("n").alias("count")).select(*edges, "count")
            insert_ignore(closed, TABLES["tumbling_counts_metrics"], path, keys_unique=True)
        finally:
            found.unpersist()
        report(counts)

    return (
        counted(log, window_seconds=window_seconds, grace=grace)
        .writeStream.queryName("tumbling_counts_metrics")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def save_live_rates(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict,
    stream: Column | str,
    **windowing: Any,
) -> StreamingQuery:
    """Events per minute and their rolling average, each minute as soon as the watermark has passed it.

    ``stream`` names the stream of an event: a raw event field, or a column that needs no message, as a literal.
    ``windowing`` are the options of ``live_rates``.
    """
    field = [stream] if isinstance(stream, str) else []
    decoded = decode(log, RAW_EVENT, ["timestamp", *field])
    name = F.col(f"data.{stream}") if field else stream
    events = decoded.select("data.timestamp", name.alias("stream"))
    return stream_to_table(
        live_rates(events, **windowing), "event_rates", path, checkpoint, trigger=trigger, keys_unique=True
    )


def _distinct(targets: Mapping[str, str | None]) -> None:
    """Refuses outputs that would write into each other."""
    named = {name: target.rstrip("/") for name, target in targets.items() if target}
    if len(set(named.values())) < len(named):
        raise ValueError(f"these outputs need a target each: {', '.join(sorted(named))}")


@dataclass(frozen=True)
class Outputs:
    """Where a routed query publishes: a topic, or a folder of JSON lines, each its own."""

    enriched: str
    dead_letter: str
    quarantine: str
    format: str = "kafka"
    servers: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        targets = {n: getattr(self, n) for n in ("enriched", "dead_letter", "quarantine")}
        missing = [name for name, target in targets.items() if not target]
        if missing:
            raise ValueError(f"outputs without a target: {', '.join(missing)}")
        _distinct(targets)

    def send(self, rows: DataFrame, target: str, query: str, batch_id: int) -> int:
        """Publishes one batch; a replayed batch adds nothing to a folder."""
        return publish_batch(
            rows,
            target,
            query,
            batch_id,
            format=self.format,
            servers=self.servers,
            options=self.options,
        )


def enrich_log(
    log: DataFrame,
    factory: Callable[[], Provider],
    outputs: Outputs,
    checkpoint: str,
    *,
    trigger: dict,
    report: Report = _log_counts,
    **asking: Any,
) -> StreamingQuery:
    """Enriches a log of raw events and routes every message to one output.

    Offsets are committed after all three outputs of a batch are written.
    ``report`` gets the message counts of every batch; ``asking`` are the
    options of ``enrich``.
    """
    def route(batch: DataFrame, batch_id: int) -> None:
        checked = with_violations(decode_tolerant(batch, RAW_EVENT)).persist()
        try:
            query = query_id(batch.sparkSession, checkpoint)
            usable, rejected = split_checked(checked)
            asked = enrich(usable, factory, **asking).select(*RAW_EVENT, "enrichment")
            # Asked once: both outputs read the same kept replies, a replay too.
            kept = kept_for_replay(asked, f"{checkpoint}/replies", batch_id)
            enriched, failed = split_enriched(kept)
            counts = {
                "batch": batch_id,
                "enriched": outputs.send(enriched, outputs.enriched, query, batch_id),
                "failed": outputs.send(failed, outputs.dead_letter, query, batch_id),
                "quarantined": outputs.send(rejected, outputs.quarantine, query, batch_id),
            }
        finally:
            checked.unpersist()
        report(counts)

    return (
        log.writeStream.queryName("enrich")
        .foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def retry_failed(
    log: DataFrame,
    factory: Callable[[], Provider],
    outputs: Outputs,
    checkpoint: str,
    *,
    trigger: dict,
    final: str,
    attempts: int = 3,
    pause: float = 60.0,
    report: Report = _log_counts,
    **asking: Any,
) -> StreamingQuery:
    """Asks again for the events in the dead letters of ``enrich_log``; ``log`` reads ``outputs.dead_letter``.

    Each event waits ``pause`` seconds, doubled with every attempt, and is asked for at most ``attempts`` times. What
    fails goes back to the dead letters, from where this query gets it again; after the last attempt it goes to
    ``final``. State holds the number of attempts of an event, so its message need not. It ends with the last attempt, or
    by a timer when the event has not come back for a day, as after a success. A query that drains the log and ends
    takes no ``pause``: what fails in one run is tried in the next.
    """
    _distinct({"enriched": outputs.enriched, "dead_letter": outputs.dead_letter, "final": final})
    if pause and "processingTime" not in trigger:
        raise ValueError("a pause needs a trigger that goes on")

    def route(batch: DataFrame, batch_id: int) -> None:
        query = query_id(batch.sparkSession, checkpoint)
        events = decode_tolerant(batch, RAW_EVENT, keep=["last"])
        asked = enrich(events, factory, **asking).select(*RAW_EVENT, "enrichment", "last")
        kept = kept_for_replay(asked, f"{checkpoint}/retries", batch_id)
        enriched, failed = split_enriched(kept)
        counts = {
            "batch": batch_id,
            "enriched": outputs.send(enriched.drop("last"), outputs.enriched, query, batch_id),
            "given_up": outputs.send(failed.filter("last").drop("last"), final, query, batch_id),
            "failed": outputs.send(failed.filter("not last").drop("last"), outputs.dead_letter, query, batch_id),
        }
        report(counts)

    failed = decode(log, RAW_EVENT, ["event_id"], keep=["payload"]).select("data.event_id", "payload")
    return (
        due_again(failed, attempts, pause)
        .writeStream.queryName("retry")
        .foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def store_log(
    log: DataFrame, root: str, checkpoint: str, *, trigger: dict, retention: str | None = None
) -> StreamingQuery:
    """Stores the enriched, valid events of a log in the lake.

    ``quarantine_log`` keeps the others; the storage job runs both.
    """
    usable, _ = split_valid(decode_tolerant(log, ENRICHED_EVENT))
    rows = to_lake_rows(usable)
    return stream_to_lake(rows, root, checkpoint, trigger=trigger, retention=retention)


def quarantine_log(log: DataFrame, path: str, checkpoint: str, *, trigger: dict) -> StreamingQuery:
    """Keeps what ``store_log`` has to leave out as unusable, with its reasons."""
    _, rejected = split_valid(decode_tolerant(log, ENRICHED_EVENT))
    return (
        rejected.writeStream.queryName("quarantine")
        .format("json")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def ingest_listings(
    pages: DataFrame,
    target: str,
    checkpoint: str,
    *,
    trigger: dict,
    quarantine: str,
    format: str = "kafka",
    servers: str | None = None,
    report: Report = _log_counts,
) -> StreamingQuery:
    """Publishes the events on newly landed listing pages to the raw log.

    Pages and children that give no event go to ``quarantine`` with the
    reasons. ``report`` gets the counts of every batch.
    """
    _distinct({"target": target, "quarantine": quarantine})

    def send(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            query = query_id(batch.sparkSession, checkpoint)
            to = {"query": query, "batch_id": batch_id, "format": format, "servers": servers}
            usable, rejected = split_items(batch)
            events = to_events(usable)
            counts = {
                "batch": batch_id,
                "sent": publish_batch(events, target, **to),
                "quarantined": publish_batch(rejected, quarantine, **to),
                "with_media": events.filter("has_media").count(),
            }
        finally:
            batch.unpersist()
        report(counts)

    return (
        pages.writeStream.queryName("ingest")
        .foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
