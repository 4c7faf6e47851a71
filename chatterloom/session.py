"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import logging
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_log = logging.getLogger(__name__)

SETTINGS = {
    # Day and hour buckets must not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The map-side rank filter behind "first n per group" covers n up to this.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Only the partitions a job produced are replaced on overwrite.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Word and topic windows can outgrow the heap; keep them in RocksDB.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting all rows costs a lookup per update.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; ``settings`` wins over them.

    Object-store access is a matter of settings as well, for example
    ``object_store_settings(...)``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, *, path_style: bool = True
) -> dict[str, str]:
    """Settings that let ``s3a://`` paths reach an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


_LOCAL_BASES: dict[str, str] = {}


def _local_base(spark: SparkSession) -> str:
    """One temporary folder per local session, deleted when Python ends."""
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_BASES:
        folder = tempfile.mkdtemp(prefix="chatterloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_BASES[application] = folder
    return _LOCAL_BASES[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables in the cluster's shared folder.

    The folder is the session's ``spark.checkpoint.dir``, with one folder in it
    for each application, deleted when its Python ends. Only a single-process
    master may do without one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base(spark)
    folder = f"{base.rstrip('/')}/chatterloom-{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(_clean, spark, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


_CLEANED: set[str] = set()


def _clean(spark: SparkSession, folder: str) -> None:
    """Deletes an application's folder at the end; a session that is gone already leaves it."""
    try:
        delete_path(spark, folder)
    except Exception:
        _log.warning("left behind: %s", folder)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _file_system(spark, path)
    return files.exists(folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder if it is there; a delete that fails raises."""
    folder, files = _file_system(spark, path)
    if files.exists(folder) and not files.delete(folder, True):
        raise OSError(f"cannot delete {path}")


def kept_for_replay(df: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """``df`` as a table of this micro-batch, the same one when the batch is replayed.

    It stays until the next batch begins, as only then the batch is known to be committed.
    """
    spark, path = df.sparkSession, f"{folder}/batch_id={batch_id}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    delete_path(spark, f"{folder}/batch_id={batch_id - 1}")
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a table in the scratch folder, deleted when the block ends.

    What is read from it stays the same when an executor is lost, which a
    cached frame with outside calls in it would not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)
