"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table, bucketed and sorted by digest, with one row per distinct text: the digest and the row
that stays. New data is reduced to one candidate per digest, anti-joined with the index by sort-merge and appended.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Within one batch the row with the largest
id stays; equal ids (repeated rows) go by a row number that is fixed when the batch is stored, so exactly one row of a
group stays. A null id is smaller than any other. Across batches the text that came first stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm.common import ascii_lower, free_name, shuffle_partitions, store


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow stored row per document: ``row``, ``id``, ``digest`` (SHA-256 of the normalised text)."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    return store(narrow, "digests")


class DigestIndex:
    """A digest table at ``path``. ``buckets`` is fixed when the index is made and must be given again to open it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint"):
        self.spark, self.name = spark, f"digest_index_{uuid.uuid4().hex}"
        self.buckets = buckets
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, id {id_type}, row BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, rows: DataFrame) -> None:
        """Appends the digests of ``rows`` (as from ``digest_rows``) that the index lacks, one row for each.

        Map-side combining leaves a hot digest one row per task before the shuffle. Repeating a batch changes nothing.
        """
        best = rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("best"))
        candidates = best.select("digest", "best.id", "best.row")
        fresh = candidates.join(self.table().hint("merge"), "digest", "left_anti")
        # Hash partitioning deals rows as bucketing does: one file a bucket.
        fresh.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Forgets the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the index did not know yet, one per text, with all their columns."""
    row = free_name(docs.columns, "dedup_row")
    docs = store(docs.withColumn(row, F.monotonically_increasing_id()), "batch")
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(
        F.col(row).alias("row"), F.col(id_col).alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    )
    rows = store(rows, "digests")
    known = store(index.table().select("digest"), "known")
    fresh = rows.join(known, "digest", "left_anti")
    index.admit(rows)
    best = fresh.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("best")).select(F.col("best.row").alias(row))
    return docs.join(best, row, "left_semi").drop(row)


def verdicts(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Per row of ``digest_rows``: the id that stays, the size of its group, whether it stays, its digest.

    The group table is stored, so that the last join has a plain exchange on both sides and adaptive execution can
    split a digest that many rows share.
    """
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    kept = index.table().select("digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"))
    groups = store(sizes.join(kept.hint("merge"), "digest"), "groups")
    return rows.join(groups.hint("merge"), "digest").select(
        F.col("id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def default_buckets(spark: SparkSession) -> int:
    return shuffle_partitions(spark)
