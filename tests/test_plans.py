"""What must hold for the plans of all queries, and for single ones."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from support import SMALL, plan_text

from workload.queries import all_queries as queries
from chatterloom.operators.decode import decode
from chatterloom.operators.merge import new_rows
from chatterloom.schemas import RAW_EVENT, TABLES
from chatterloom.sinks.tables import (
    CHUNK_DAYS,
    _chunked,
    _key_filters,
    _overlapping,
    append_table,
    merged_spans,
    read_table,
)
from workload import frames

# These run streams or write tables before they return a plain scan.
EAGER = {n for n in queries() if n.endswith("_stream") or n.startswith(("job_suite_", "route_"))} | {
    "dead_letter_retries",
    "daily_sentiment_incremental",
    "weekly_topics_incremental",
    "daily_sentiment_bounded",
    "lake_roundtrip",
    "ingest_to_lake",
    "log_of_two_streams",
    "insert_ignore_table",
    "append_only_table",
    "event_rates_job",
}
# Global aggregates: one row per task reaches the single last task.
GLOBAL = {"dedup_report_events", "retention"}


@pytest.mark.parametrize("name", sorted(set(queries()) - EAGER))
def test_plan(spark, name):
    plan = plan_text(queries()[name](spark, SMALL), "simple")
    for slow in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert slow not in plan
    assert name in GLOBAL or "SinglePartition" not in plan
    assert "ArrowEvalPython" not in plan or name.startswith("enrich_")
    assert plan.count("from_json") <= 1


def test_a_plan_starts_no_job(spark):
    """Building a query's frame runs nothing but the one job that reads the schema of its table."""
    tracker = spark.sparkContext.statusTracker()
    for name in ("poll_newest", "incremental_cursor", "prompt_pack", "enrich_route", "daily_sentiment"):
        spark.sparkContext.setJobGroup(f"plan {name}", name)
        queries()[name](spark, SMALL)
        assert len(tracker.getJobIdsForGroup(f"plan {name}")) <= 1, name
    spark.sparkContext.setJobGroup("other", "other")


def test_prompts_are_packed_with_one_shuffle(spark):
    plan = plan_text(queries()["prompt_pack"](spark, SMALL), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_only_needed_columns_are_read(spark):
    plan = plan_text(queries()["event_rate"](spark, SMALL), "simple")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = plan_text(queries()["weekly_topics"](spark, SMALL), "simple")
    assert "user_id" not in plan.split("ReadSchema", 1)[1]


def test_merge_prunes_folders_and_row_groups(spark, path):
    table = TABLES["raw_events"]
    append_table(frames.raw_events(spark, SMALL), table, path("t"))
    message = json.dumps({"event_id": "1", "timestamp": "2024-01-10T01:00:00Z"})
    log = spark.createDataFrame([(message,)], "payload string")
    rows = _chunked(decode(log, RAW_EVENT).select("data.*"), table, CHUNK_DAYS)
    target = read_table(spark, table, path("t"))
    for margin in (timedelta(), timedelta(minutes=1)):
        stored = _overlapping(target, rows, table, CHUNK_DAYS, margin)
        plan = plan_text(new_rows(rows, stored, table.keys))
        scan = plan[plan.index("Scan parquet") :]
        lines = {l.split(":")[0]: l for l in scan.splitlines() if ":" in l}
        assert "2024-01-08" in lines["PartitionFilters"] or "chunk_start" in lines["PartitionFilters"]
        assert "GreaterThanOrEqual(timestamp" in lines["PushedFilters"]
        assert lines["ReadSchema"].strip() == "ReadSchema: struct<event_id:string,timestamp:timestamp>"


def test_a_merge_opens_the_chunks_of_its_events_alone(spark, path):
    """A batch of this week with one event two years old looks into two chunks, not into a hundred."""
    table = TABLES["raw_events"]

    def events(*days):
        made = [{"event_id": f"e{d}", "timestamp": f"{d}T12:00:00Z"} for d in days]
        log = spark.createDataFrame([(json.dumps(m),) for m in made], "payload string")
        return decode(log, RAW_EVENT).select("data.*")

    stored_days = [f"20{y}-{m:02d}-{d:02d}" for y in (22, 23) for m in range(1, 13) for d in (3, 17)] + ["2024-01-09", "2024-01-10"]
    append_table(events(*stored_days), table, path("t"))
    target = read_table(spark, table, path("t"))
    for extra in ([], [f"2024-01-09T00:00:{n:02d}" for n in range(20)]):
        batch = events("2022-01-17", "2024-01-09")
        more = spark.createDataFrame([(f"x{t}", t) for t in extra], "event_id string, t string")
        batch = batch.unionByName(more.select("event_id", F.to_timestamp("t").alias("timestamp")), allowMissingColumns=True)
        found = _overlapping(target, _chunked(batch, table, CHUNK_DAYS), table, CHUNK_DAYS, timedelta())
        # Few new keys of a chunk: the scan is asked for them; many: for their times.
        assert {r.event_id for r in found.collect()} == {"e2022-01-17", "e2024-01-09"}
        read = found.select(F.input_file_name().alias("f")).distinct().collect()
        assert {r.f.split("chunk_start=")[1][:10] for r in read} == {"2022-01-17", "2024-01-08"}
        plan = plan_text(found)
        scan = {l.split(":")[0]: l for l in plan[plan.index("Scan parquet") :].splitlines() if ":" in l}
        assert "2022-01-17" in scan["PartitionFilters"] or "chunk_start" in scan["PartitionFilters"]
        assert "event_id" in scan["PushedFilters"]


def test_spans_are_merged_to_a_bounded_number():
    assert merged_spans([(5, 6), (1, 2), (2, 3), (10, 20), (12, 13)]) == [(1, 3), (5, 6), (10, 20)]
    many = merged_spans([(100 * n, 100 * n + 1) for n in range(200)] + [(50_000, 50_001)], 3)
    assert len(many) == 3 and many[-1] == (50_000, 50_001) and many[0][0] == 0


def test_tables_have_bloom_filters_on_their_text_keys(spark, path):
    """The filters make a file longer; the reader finds keys in it all the same."""
    table = TABLES["raw_events"]
    append_table(frames.raw_events(spark, SMALL), table, path("t"))
    frames.raw_events(spark, SMALL).select(*table.columns).coalesce(1).write.parquet(path("plain"))
    assert _key_filters(table) == {"parquet.bloom.filter.enabled#event_id": "true"}
    key = frames.raw_events(spark, SMALL).select("event_id").first()[0]
    assert read_table(spark, table, path("t")).filter(F.col("event_id") == key).count() == 1
    assert read_table(spark, table, path("t")).filter(F.col("event_id") == "none").count() == 0
