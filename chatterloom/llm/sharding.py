"""Shards by a two-pass external shuffle.

Pass one scatters the records uniformly into memory-sized buckets by a seeded hash of the whole record's id and text.
Pass two puts the records of a bucket in a canonical order, shuffles them (Fisher-Yates, seeded by bucket) and writes
them. The buckets, one after the other, are one random order of all records; shards are equal runs of it, so their row
counts differ by one at most (law ``rows``) and the slots of a shard have no gaps.

The driver holds one count per bucket, eight bytes for each ``bucket_bytes`` of input. Equal records (same id and
text) share a bucket. Nulls are records like any other. A column of the input named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from chatterloom.llm.common import free_name, map_arrow, shuffle_partitions, without
from chatterloom.session import scratch_path

LAW = "rows"


def bucket_count(docs: DataFrame, text_col: str, bucket_bytes: int) -> int:
    """Buckets of ``bucket_bytes`` at most on average, several a task at least so that tasks are even."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)).first()[0] or 0
    return max(-(-total // bucket_bytes), 8 * shuffle_partitions(docs.sparkSession))


def shuffled(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """The columns of ``docs`` with ``shard`` and ``slot``."""
    docs = without(docs, "shard", "slot")
    buckets = bucket_count(docs, text_col, bucket_bytes)
    mark, bucket = free_name(docs.columns, "scatter_hash"), free_name(docs.columns, "scatter_bucket")
    hashed = docs.withColumn(mark, F.xxhash64(F.lit(seed), id_col, text_col))
    scattered = hashed.withColumn(bucket, F.pmod(mark, F.lit(buckets)))
    counts = np.zeros(buckets, np.int64)
    for row in scattered.groupBy(bucket).count().collect():
        counts[row[0]] = row[1]
    starts = np.concatenate(([0], np.cumsum(counts)))
    base, extra = divmod(int(starts[-1]), shards)
    edges = np.concatenate(([0], np.cumsum([base + (s < extra) for s in range(shards)])))
    names = docs.columns

    def permuted(rows: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
        order = np.random.default_rng([seed, number]).permutation(rows.num_rows)  # a Fisher-Yates shuffle
        places = starts[number] + np.arange(rows.num_rows)
        shard = np.searchsorted(edges, places, "right") - 1
        taken = rows.select(names).take(pa.array(order))
        taken = taken.append_column("shard", pa.array(shard.astype(np.int32)))
        taken = taken.append_column("slot", pa.array(places - edges[shard]))
        yield from taken.combine_chunks().to_batches(max_chunksize=1024)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            numbers = batch.column(bucket).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.nonzero(np.diff(numbers))[0] + 1).tolist(), len(numbers)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if high == low:
                    continue
                if current is not None and numbers[low] != current:
                    yield from permuted(pa.Table.from_batches(held), current)
                    held = []
                current = int(numbers[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from permuted(pa.Table.from_batches(held), current)

    partitions = min(buckets, max(shuffle_partitions(docs.sparkSession), buckets // 8))
    dealt = scattered.repartition(partitions, bucket).sortWithinPartitions(bucket, mark, id_col)
    schema = StructType([*docs.schema.fields, StructField("shard", IntegerType()), StructField("slot", LongType())])
    return map_arrow(dealt, work, schema)


def write_shards(docs: DataFrame, shards: int, path: str | None = None, **options) -> str:
    """Writes ``path``/shard=0, 1, ...; files hold ascending slots. Returns the path (the shared folder's by default)."""
    path = path or scratch_path(docs.sparkSession, "shards")
    found = shuffled(docs, shards, **options)
    found.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
