"""Event logs: message streams of one JSON document per event."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log(
    spark: SparkSession,
    source: str,
    *,
    format: str = "kafka",
    servers: str | None = None,
    streaming: bool = True,
    batch_limit: int | None = None,
    fail_on_data_loss: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages of one topic, or of one folder of JSON-lines files, as ``payload``.

    A stream starts at the earliest message and keeps its position in the
    checkpoint of the query that reads it. ``batch_limit`` bounds a micro-batch:
    in messages of a topic, in files of a folder. Offsets that a topic no
    longer has stop the query unless ``fail_on_data_loss`` is false. Other
    ``options`` reach the reader, for example ``minPartitions``. A log folder
    is read with all folders in it.
    """
    options = dict(options or {})
    if batch_limit is not None and streaming:
        bound = "maxOffsetsPerTrigger" if format == "kafka" else "maxFilesPerTrigger"
        options.setdefault(bound, str(batch_limit))
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", source)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        messages = reader.options(**options).load()
    else:
        options.setdefault("recursiveFileLookup", "true")
        messages = reader.format(format).options(**options).load(source)
    return messages.select(F.col("value").cast("string").alias("payload"))
