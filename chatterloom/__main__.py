"""Runs one job: ``spark-submit ... -m chatterloom <job> [options]``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterloom.operators.enrich import provider_factory
from chatterloom.plans.batch import JOBS, run_job, run_jobs, run_rates
from chatterloom.session import build_session
from chatterloom.sources.listings import read_listings
from chatterloom.sources.logs import read_log
from chatterloom.streaming import queries as streams
from chatterloom.streaming.control import POLL_SECONDS, checkpoint_path, run_together, trigger

TABLE_STREAMS = {
    "save_raw": (streams.save_raw, "raw_events"),
    "save_enriched": (streams.save_enriched, "enriched_events"),
    "trending_words": (streams.save_trending_words, "trending_words_metrics"),
    "trending_topics": (streams.save_trending_topics, "trending_topics_metrics"),
    "tumbling_counts": (streams.save_tumbling_counts, "tumbling_counts_metrics"),
}
# Bounds of a micro-batch, so that a first run over an old topic is no single batch.
BATCH_MESSAGES = 100_000
BATCH_FILES = 100
STREAMS = ("ingestion", "processing", "retry", "storage", "live_rates", *TABLE_STREAMS)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="chatterloom", description=__doc__)
    parser.add_argument("job", choices=[*STREAMS, *JOBS, "all_batch", "event_rates"])
    parser.add_argument("--source", help="topic, log folder, or landed listing pages")
    parser.add_argument("--output", required=True, help="topic, lake or folder of result tables")
    parser.add_argument("--lake", help="event lake (or, for event_rates, folder of event tables) to read")
    parser.add_argument("--dead-letter", help="topic or folder for events without enrichment; retry reads it")
    parser.add_argument("--final", help="topic or folder for events that retry gives up")
    parser.add_argument("--attempts", type=int, default=3, help="how often retry asks for an event")
    parser.add_argument("--pause", type=float, default=60.0, help="seconds before the first retry; none with --once")
    parser.add_argument(
        "--quarantine",
        help="topic or folder for unusable messages (a folder for the save and storage jobs)",
    )
    parser.add_argument("--format", default="kafka", help="kafka, or text for JSON-lines folders")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--checkpoints", help="base folder of the streams' checkpoints")
    parser.add_argument(
        "--provider", default="dummy", help="registered provider, or package.module:factory"
    )
    parser.add_argument(
        "--batch-limit", type=int, help=f"messages of a micro-batch (default {BATCH_MESSAGES}), or files of a folder (default {BATCH_FILES})"
    )
    parser.add_argument(
        "--allow-data-loss", action="store_true", help="go on when a topic no longer has offsets"
    )
    parser.add_argument("--max-seconds", type=float, help="stop the stream after this time")
    parser.add_argument("--poll-seconds", type=int, default=POLL_SECONDS)
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    parser.add_argument("--since", type=date.fromisoformat, help="first day, for batch jobs")
    parser.add_argument("--until", type=date.fromisoformat, help="day after the last one")
    args = parser.parse_args(argv)
    lacking = [f"--{n.replace('_', '-')}" for n in _required(args.job) if not getattr(args, n)]
    if lacking:
        parser.error(f"{args.job} needs {', '.join(lacking)}")
    return args


def _required(job: str) -> list[str]:
    if job not in STREAMS:
        return ["lake"] if job in (*JOBS, "all_batch", "event_rates") else []
    needed = ["source", "checkpoints"]
    if job == "retry":
        return ["dead_letter", "final", "quarantine", "checkpoints"]
    if job in ("ingestion", "processing", "storage", "save_raw", "save_enriched"):
        needed.append("quarantine")
    return [*needed, "dead_letter"] if job == "processing" else needed


def _start(spark, args: argparse.Namespace) -> list[StreamingQuery]:
    when = trigger(once=args.once, seconds=args.poll_seconds)
    where = {"format": args.format, "servers": args.servers}

    def checkpoint(table: str) -> str:
        return checkpoint_path(args.checkpoints, table, args.job)

    if args.job == "ingestion":
        limit = str(args.batch_limit or BATCH_FILES)
        pages = read_listings(spark, args.source, streaming=True, maxFilesPerTrigger=limit)
        query = streams.ingest_listings(
            pages, args.output, checkpoint("raw_log"), trigger=when, quarantine=args.quarantine, **where
        )
        return [query]
    default = BATCH_MESSAGES if args.format == "kafka" else BATCH_FILES
    log = read_log(
        spark,
        args.dead_letter if args.job == "retry" else args.source,
        batch_limit=args.batch_limit or default,
        fail_on_data_loss=not args.allow_data_loss,
        **where,
    )
    if args.job == "processing":
        outputs = streams.Outputs(args.output, args.dead_letter, args.quarantine, **where)
        factory = provider_factory(args.provider)
        return [streams.enrich_log(log, factory, outputs, checkpoint("enriched_log"), trigger=when)]
    if args.job == "retry":
        outputs = streams.Outputs(args.output, args.dead_letter, args.quarantine, **where)
        query = streams.retry_failed(
            log, provider_factory(args.provider), outputs, checkpoint("retries"), trigger=when,
            final=args.final, attempts=args.attempts, pause=0.0 if args.once else args.pause,
        )
        return [query]
    if args.job == "live_rates":
        stream = F.lit(args.source.rstrip("/").rpartition("/")[2])
        return [streams.save_live_rates(log, f"{args.output}/event_rates", checkpoint("event_rates"), trigger=when, stream=stream)]
    if args.job == "storage":
        return [
            streams.store_log(log, args.output, checkpoint("lake"), trigger=when),
            streams.quarantine_log(log, args.quarantine, checkpoint("quarantine"), trigger=when),
        ]
    save, table = TABLE_STREAMS[args.job]
    extra = {"quarantine": args.quarantine} if args.job.startswith("save_") else {}
    return [save(log, f"{args.output}/{table}", checkpoint(table), trigger=when, **extra)]


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"chatterloom-{args.job}")
    if args.job in STREAMS:
        run_together(_start(spark, args), args.max_seconds)
    elif args.job == "event_rates":
        run_rates(spark, args.lake, args.output)
    elif args.job == "all_batch":
        run_jobs(spark, args.lake, args.output, since=args.since, until=args.until)
    else:
        run_job(spark, args.job, args.lake, args.output, since=args.since, until=args.until)


if __name__ == "__main__":
    main()
