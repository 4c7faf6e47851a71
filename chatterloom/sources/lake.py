"""The event lake: Parquet partitioned by year, month and day of the event."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.schemas import LAKE_EVENT, LAKE_PARTITIONS, ddl
from chatterloom.session import path_exists


def read_lake(
    spark: SparkSession,
    root: str,
    *,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Events of the days ``since <= day < until``, with the lake's fixed schema.

    With both bounds only the folders of these days are listed. With one, the
    partition columns prune the scan after listing.
    """
    reader = spark.read.schema(ddl({**LAKE_EVENT, **LAKE_PARTITIONS}))
    if since is not None and until is not None:
        days = [since + timedelta(days=n) for n in range((until - since).days)]
        folders = [f"{root}/year={d.year}/month={d.month:02d}/day={d.day:02d}" for d in days]
        there = [folder for folder in folders if path_exists(spark, folder)]
        if not there:
            return reader.parquet(root).filter(F.lit(False))
        if not path_exists(spark, f"{root}/_spark_metadata"):  # a stream's log lists its own files
            return reader.option("basePath", root).parquet(*there)
    lake = reader.parquet(root)
    day = F.make_date("year", "month", "day")
    if since is not None:
        lake = lake.filter(day >= F.lit(since))
    if until is not None:
        lake = lake.filter(day < F.lit(until))
    return lake
