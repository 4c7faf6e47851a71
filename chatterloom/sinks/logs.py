"""Publishing events as JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chatterloom.operators.flatten import to_messages
from chatterloom.session import path_exists


def publish(
    events: DataFrame,
    target: str,
    *,
    format: str = "kafka",
    servers: str | None = None,
    key: str | None = None,
    mode: str = "append",
    options: Mapping[str, str] | None = None,
) -> int:
    """Writes a batch of events to a topic, or as JSON lines to a folder.

    Returns the number of messages, counted while they are written. A failed
    write raises; nothing is dropped silently.
    """
    messages = to_messages(events, key)
    sent = Observation()
    messages = messages.observe(sent, F.count("*").alias("sent"))
    if format == "kafka":
        writer = (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", target)
        )
        writer.options(**(options or {})).save()
    else:
        writer = messages.select("value").write.format(format).mode(mode)
        writer.options(**(options or {})).save(target)
    return sent.get["sent"]


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the streaming query behind a checkpoint; a new checkpoint is a new query."""
    (line,) = spark.read.text(f"{checkpoint}/metadata").collect()
    return spark.sql("SELECT get_json_object(?, '$.id')", args=[line[0]]).first()[0]


def publish_batch(
    events: DataFrame,
    target: str,
    query: str,
    batch_id: int,
    *,
    format: str = "kafka",
    servers: str | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Publishes one micro-batch.

    In a folder, every batch of every query has files of its own: no other
    query, and no query with a new checkpoint, writes there. A batch that is
    complete is left as it is when it is replayed, so that a reader never sees
    it under other file names.
    """
    if format == "kafka":
        return publish(events, target, format=format, servers=servers, options=options)
    folder = f"{target}/query={query}/batch_id={batch_id}"
    spark = events.sparkSession
    if path_exists(spark, f"{folder}/_SUCCESS"):
        return spark.read.format(format).load(folder).count()
    return publish(events, folder, format=format, mode="overwrite", options=options)
