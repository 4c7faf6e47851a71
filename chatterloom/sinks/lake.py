"""Writing and compacting the event lake."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterloom.functions.time import day_partitions
from chatterloom.schemas import LAKE_EVENT, LAKE_PARTITIONS
from chatterloom.sources.lake import read_lake

_LAYOUT = list(LAKE_PARTITIONS)


def _by_day(rows: DataFrame) -> DataFrame:
    """Lake rows in their fixed types, each with its own day, ready to write.

    Rebalanced by day: few files per day, while a day that outgrows one task
    is split. Adaptive execution does this for stateless streams, too.
    """
    typed = rows.select([F.col(n).cast(t).alias(n) for n, t in LAKE_EVENT.items()])
    return typed.withColumns(day_partitions(F.col("timestamp"))).hint("rebalance", *_LAYOUT)


def is_streamed(spark: SparkSession, root: str) -> bool:
    """Whether a stream writes this lake. Its readers see only the stream's files."""
    log = spark._jvm.org.apache.hadoop.fs.Path(root, "_spark_metadata")
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)


def write_lake(rows: DataFrame, root: str, *, mode: str = "append") -> None:
    """Adds lake rows to the folders of their days, or overwrites these days.

    A lake written by a stream takes no other rows.
    """
    if is_streamed(rows.sparkSession, root):
        raise ValueError(f"{root} is written by a stream; compact it into another lake first")
    (
        _by_day(rows)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*_LAYOUT)
        .parquet(root)
    )


def stream_to_lake(
    rows: DataFrame, root: str, checkpoint: str, *, trigger: dict, retention: str | None = None
) -> StreamingQuery:
    """Streams lake rows into the folders of their days, each row exactly once.

    The file log behind this forgets files after ``retention`` ("90 days").
    """
    return (
        _by_day(rows)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*_LAYOUT)
        .option("compression", "snappy")
        .option("checkpointLocation", checkpoint)
        .options(**({"retention": retention} if retention else {}))
        .trigger(**trigger)
        .start(root)
    )


def compact_lake(
    spark: SparkSession,
    root: str,
    target: str,
    *,
    since: date | None = None,
    until: date | None = None,
) -> None:
    """Rewrites days of one lake as few large files into another lake."""
    days = read_lake(spark, root, since=since, until=until)
    write_lake(days.select(*LAKE_EVENT), target, mode="overwrite")
