"""Result tables: snapshots, appends and replay-safe merges."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, timedelta
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.functions.time import chunk_start
from chatterloom.operators.dedup import dedup_latest
from chatterloom.operators.merge import new_rows
from chatterloom.schemas import Table, ddl
from chatterloom.session import delete_path, path_exists

CHUNK = "chunk_start"
CHUNK_DAYS = 7


def _in_chunks(df: DataFrame, table: Table, chunk_days: int) -> DataFrame:
    return df.withColumn(CHUNK, chunk_start(F.col(table.time), chunk_days))


def _chunked(df: DataFrame, table: Table, chunk_days: int) -> DataFrame:
    return _in_chunks(table.conform(df), table, chunk_days)


def read_table(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """All rows of a result table with its fixed schema, and their chunk."""
    return spark.read.schema(f"{ddl(table.columns)}, {CHUNK} date").parquet(path)


def replace_table(
    df: DataFrame,
    table: Table,
    path: str,
    *,
    chunk_days: int = CHUNK_DAYS,
    whole: bool = True,
    span: tuple[date | None, date | None] | None = None,
) -> None:
    """Snapshot write. With ``whole=False`` only the chunks in ``df`` are replaced;
    a chunk without rows keeps what it has, unless it lies in ``span`` (whole
    chunks, first day and day after the last): then it is deleted.
    """
    bounded = not whole and span is not None
    rows = _chunked(df, table, chunk_days)
    rows = rows.persist() if bounded else rows
    (
        rows.hint("rebalance", CHUNK)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .options(**_key_filters(table))
        .partitionBy(CHUNK)
        .parquet(path)
    )
    if bounded:
        first, end = span
        filled = {r[0] for r in rows.select(CHUNK).distinct().collect()}
        for start in chunk_folders(df.sparkSession, path):
            inside = (first is None or start >= first) and (end is None or start < end)
            if inside and start not in filled:
                delete_path(df.sparkSession, f"{path}/{CHUNK}={start.isoformat()}")
        rows.unpersist()


def chunk_folders(spark: SparkSession, path: str) -> list[date]:
    """First days of the chunks a table has."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"{CHUNK}=????-??-??")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.globStatus(folder) or ()]
    return sorted(date.fromisoformat(name.partition("=")[2]) for name in names)


def append_table(df: DataFrame, table: Table, path: str, *, chunk_days: int = CHUNK_DAYS) -> None:
    """Adds rows as they are."""
    rows = _chunked(df, table, chunk_days).hint("rebalance", CHUNK)
    rows.write.mode("append").options(**_key_filters(table)).partitionBy(CHUNK).parquet(path)


#: Spans of times a merge looks into apart; nearer ones are looked into as one beyond that.
_MOST_SPANS = 64
#: A chunk with so few new keys is asked for these keys alone, which Parquet's Bloom filters answer.
_FEW_KEYS = 10


def _key_filters(table: Table) -> dict[str, str]:
    """Write options that give each row group a Bloom filter on the table's text keys."""
    return {f"parquet.bloom.filter.enabled#{k}": "true" for k in table.keys if table.columns[k] == "string"}


def merged_spans(spans: Iterable[tuple[int, int]], most: int = _MOST_SPANS) -> list[tuple[int, int]]:
    """The spans in order, overlapping ones as one, and then the nearest, until ``most`` are left."""
    found: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    gaps = sorted(range(1, len(found)), key=lambda n: found[n][0] - found[n - 1][1])
    joined = set(gaps[: max(len(found) - most, 0)])
    out: list[tuple[int, int]] = []
    for n, span in enumerate(found):
        if n in joined:
            out[-1] = (out[-1][0], span[1])
        else:
            out.append(span)
    return out


def _overlapping(
    target: DataFrame, rows: DataFrame, table: Table, chunk_days: int, margin: timedelta, *, keyed: bool = True
) -> DataFrame | None:
    """The part of ``target`` that may hold keys of ``rows``; None without rows.

    Keys hold the time column, so only the same times, give or take ``margin``
    (at most a chunk), can repeat them. Every chunk of the batch has a span of
    its own: one old event does not open the chunks between. The chunks prune
    folders, the times row groups, as a file holds the times of the batches it
    came from, and the keys of a chunk with few of them do so by Bloom filters.
    Without a margin only: a caller that gives one wants other keys as well.
    Rows that are not ``keyed`` have the times of the keys alone.
    """
    around, time = margin // timedelta(microseconds=1), table.time
    named = next((k for k in table.keys if table.columns[k] == "string"), None) if keyed else None
    spans = rows.groupBy(CHUNK).agg(
        F.min(F.unix_micros(time)).alias("low"),
        F.max(F.unix_micros(time)).alias("high"),
        F.count(F.lit(1)).alias("n"),
    ).collect()  # one row a chunk
    if any(r[CHUNK] is None for r in spans):
        raise ValueError(f"rows without {time} have no key")
    if not spans:
        return None
    few = [r[CHUNK] for r in spans if r["n"] <= _FEW_KEYS and named and not around]
    asked: dict[date, set[str]] = {}
    if few:
        for chunk, key in rows.filter(F.col(CHUNK).isin(few)).select(CHUNK, named).collect():
            asked.setdefault(chunk, set()).add(key)

    def near(low: int, high: int) -> tuple[Column, Column]:
        first, last = (chunk_start(F.timestamp_micros(F.lit(t)), chunk_days) for t in (low, high))
        times = F.col(time).between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high)))
        return F.col(CHUNK).between(first, last), times

    wide = merged_spans((r["low"] - around, r["high"] + around) for r in spans if r[CHUNK] not in asked)
    parts = [near(low, high) for low, high in wide]
    for r in spans:
        if r[CHUNK] in asked:
            chunk, times = near(r["low"], r["high"])
            parts.append((chunk, times & F.col(named).isin(sorted(k for k in asked[r[CHUNK]] if k is not None))))
    chunks = reduce(or_, [chunk for chunk, _ in parts])
    return target.filter(chunks).filter(reduce(or_, [chunk & rest for chunk, rest in parts]))


def insert_ignore(
    batch: DataFrame,
    table: Table,
    path: str,
    *,
    keys_unique: bool = False,
    chunk_days: int = CHUNK_DAYS,
    admit: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    refused: Callable[[DataFrame], None] | None = None,
    margin: timedelta = timedelta(),
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Appends the rows whose key the table lacks; repeats change nothing.

    Reads back only keys in the chunks of the batch, each in its own time span.
    ``keys_unique`` says that no key repeats inside the batch, as after an
    aggregation. ``admit`` may select among the new rows, given those stored
    in the batch's time span and ``margin`` around it; ``refused`` is given the
    others, before the table changes. Of copies within a batch the first by the
    other columns, largest values first, stays. Rows without a time have
    no key and are refused. Safe against replays by one writer; two writers
    must not share a table.

    ``derive`` makes the rows from those of the batch, which have their times: the few
    are kept, and tell the spans, and the many are written as they are made.
    """
    spark = batch.sparkSession
    # Kept, so that a streaming batch is evaluated once.
    kept = (_chunked(batch, table, chunk_days) if derive is None else _in_chunks(batch, table, chunk_days)).persist()
    try:
        rows = kept if derive is None else _chunked(derive(kept.drop(CHUNK)), table, chunk_days)
        target = read_table(spark, table, path) if path_exists(spark, path) else rows.limit(0)
        stored = _overlapping(target, kept, table, chunk_days, margin, keyed=derive is None)
        if stored is None:
            return
        fresh = rows if keys_unique else dedup_latest(rows, table.keys, ())
        fresh = new_rows(fresh, stored, table.keys)
        if admit is not None:
            new, fresh = fresh, admit(fresh, stored)
            if refused is not None:
                refused(new_rows(new, fresh, table.keys).drop(CHUNK))
        writer = fresh.hint("rebalance", CHUNK).write.mode("append").options(**_key_filters(table))
        writer.partitionBy(CHUNK).parquet(path)
    finally:
        kept.unpersist()


def insert_ignore_batches(
    table: Table, path: str, **options: Any
) -> Callable[[DataFrame, int], None]:
    """``insert_ignore`` as a ``foreachBatch`` function."""
    def write(batch: DataFrame, batch_id: int) -> None:
        insert_ignore(batch, table, path, **options)

    return write


def _jdbc(url: str, table_name: str, credentials: Mapping[str, str] | None) -> dict[str, str]:
    return {"url": url, "dbtable": table_name, **(credentials or {})}


def write_jdbc(
    df: DataFrame,
    table: Table,
    url: str,
    table_name: str,
    *,
    mode: str = "append",
    credentials: Mapping[str, str] | None = None,
) -> None:
    """Appends to, or replaces the rows of, a database table.

    Replacing truncates, so the table keeps its keys and indexes.
    """
    writer = table.conform(df).write.format("jdbc").options(**_jdbc(url, table_name, credentials))
    writer.option("truncate", "true").mode(mode).save()


def insert_ignore_jdbc(
    batch: DataFrame,
    table: Table,
    url: str,
    table_name: str,
    *,
    credentials: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """``insert_ignore`` for a database table; a failed write raises.

    Only the keys in the batch's time range are read back, over several
    ``connections`` that share the range.
    """
    spark = batch.sparkSession
    rows = table.conform(batch).persist()
    try:
        micros = F.unix_micros(table.time)
        low, high = rows.agg(F.min(micros), F.max(micros)).first()
        if low is None:
            return
        edges = [F.timestamp_micros(F.lit(edge)) for edge in (low, high)]
        texts = spark.range(1).select(*[e.cast("string") for e in edges]).first()
        share = {
            "partitionColumn": table.time,
            "lowerBound": texts[0],
            "upperBound": texts[1],
            "numPartitions": str(connections),
        }
        reader = spark.read.format("jdbc").options(**_jdbc(url, table_name, credentials), **share)
        stored = reader.load().filter(F.col(table.time).between(*edges))
        fresh = new_rows(dedup_latest(rows, table.keys, ()), stored, table.keys)
        write_jdbc(fresh, table, url, table_name, credentials=credentials)
    finally:
        rows.unpersist()
