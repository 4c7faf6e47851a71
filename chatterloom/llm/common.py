"""What several operators share: stored intermediate tables and files in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.session import delete_path, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str, *partition: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    return read_stored(df, write_scratch(df, label, *partition))


_MADE: list[list[str]] = []


def settled(build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, stored; the tables it stored on its way are deleted then."""
    _MADE.append([])
    try:
        df = build()
        path = scratch_path(df.sparkSession, label)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        made = _MADE.pop()
    for one in made:
        delete_path(df.sparkSession, one)
    return read_stored(df, path)


def write_scratch(df: DataFrame, label: str, *partition: str) -> str:
    path = scratch_path(df.sparkSession, label)
    if _MADE:
        _MADE[-1].append(path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return path


def read_stored(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def free_name(columns: Iterable[str], base: str) -> str:
    """``base``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns that carry a name an operator is about to give (case-insensitively)."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def file_system(path: str):
    """A pyarrow file system for ``path`` and the path inside it, for files that tasks write or range-read."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    uri = path.replace("s3a://", "s3://", 1) if parsed.scheme == "s3a" else path
    return fs.FileSystem.from_uri(uri)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes too, as a row can be a very long text."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInArrow(function, schema)


def map_pandas(df: DataFrame, function, schema) -> DataFrame:
    """``mapInPandas``, bounded likewise."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInPandas(function, schema)
