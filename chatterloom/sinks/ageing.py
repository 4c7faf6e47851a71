"""Dropping old partitions of the lake and of result tables.

Both work on folder names alone; no data is read or rewritten.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession

from chatterloom.sinks.lake import is_streamed
from chatterloom.sinks.tables import CHUNK, CHUNK_DAYS


def drop_days_before(spark: SparkSession, root: str, keep_days: int, as_of: date) -> list[date]:
    """Deletes the lake's days older than ``keep_days`` before ``as_of``.

    Not for a lake that a stream writes: that one has its own ``retention``.
    """
    if is_streamed(spark, root):
        raise ValueError(f"{root} is written by a stream; set its retention instead")
    oldest = as_of - timedelta(days=keep_days)

    def is_old(parts: dict[str, str]) -> date | None:
        levels = [parts[name] for name in ("year", "month", "day")]
        if not all(level.isdigit() for level in levels):
            return None  # rows without a time have no age
        day = date(*map(int, levels))
        return day if day < oldest else None

    return _drop(spark, root, "year=*/month=*/day=*", is_old)


def drop_chunks_before(
    spark: SparkSession,
    path: str,
    keep_days: int,
    as_of: date,
    *,
    chunk_days: int = CHUNK_DAYS,
) -> list[date]:
    """Deletes the chunks of a result table whose last day is too old."""
    oldest = as_of - timedelta(days=keep_days)

    def is_old(parts: dict[str, str]) -> date | None:
        start = date.fromisoformat(parts[CHUNK])
        return start if start + timedelta(days=chunk_days) <= oldest else None

    return _drop(spark, path, f"{CHUNK}=????-??-??", is_old)


def _drop(spark: SparkSession, root: str, pattern: str, is_old) -> list[date]:
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    files = path_class(root).getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in files.globStatus(path_class(root, pattern)):
        folder = status.getPath()
        levels = folder.toString().split("/")[-(pattern.count("/") + 1) :]
        partition = is_old(dict(level.split("=", 1) for level in levels))
        if partition:
            if not files.delete(folder, True):
                raise OSError(f"cannot delete {folder}")
            dropped.append(partition)
    return sorted(dropped)
