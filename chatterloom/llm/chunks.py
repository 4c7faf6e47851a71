"""Documents stored in chunks, and packed arrays that travel between them.

Operators that look for repeats inside texts go back and forth between two views: by document (to read its text) and by
hash (to find equal pieces). The texts are written once, in chunks of whole documents, to the shared folder and never
shuffled. What is shuffled are packed numpy arrays, a row for each chunk and bucket of hashes; a reply finds its chunk
by number, and the task reads that chunk's file again. A lost executor costs its tasks, nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm.common import file_system, map_arrow, read_stored, shuffle_partitions, write_scratch

NO_ID = np.iinfo(np.int64).max  # a null id is larger than any other
BLOBS = "bucket bigint, chunk bigint, data binary"


@dataclass(frozen=True)
class ChunkStore:
    path: str
    frame: DataFrame  # chunk, row, id, text
    n_bytes: int
    n_chunks: int

    @property
    def spark(self) -> SparkSession:
        return self.frame.sparkSession


@dataclass(frozen=True)
class Chunk:
    number: int
    rows: np.ndarray
    ids: np.ndarray  # NO_ID for null
    texts: list[bytes]


def store_chunks(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = 16 << 20) -> ChunkStore:
    """Writes ``chunk=N`` folders; a chunk holds consecutive rows of one scan task. ``row`` numbers all rows."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, size = 0, 0
        for batch in batches:
            rows = batch.column("row").to_numpy()
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy()
            chunk = np.empty(len(rows), np.int64)
            for i, length in enumerate(lengths.tolist()):
                if size and size + length > chunk_bytes:
                    count, size = count + 1, 0
                size += length
                chunk[i] = (rows[i] >> 33 << 20) + count  # the task's number, then its count
            yield pa.RecordBatch.from_arrays([pa.array(chunk), *batch.columns], names=["chunk", *batch.schema.names])

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    chunked = map_arrow(narrow, number, "chunk bigint, row bigint, id bigint, text binary")
    path = write_scratch(chunked, "chunks", "chunk")
    frame = read_stored(chunked, path)
    n_bytes, n_chunks = frame.agg(F.sum(F.length("text")), F.count_distinct("chunk")).first()
    return ChunkStore(path, frame, n_bytes or 0, n_chunks)


def load_chunk(path: str, number: int) -> Chunk:
    """One chunk, in the order of its rows: always the same arrays."""
    system, inner = file_system(f"{path}/chunk={number}")
    from pyarrow.fs import FileSelector

    files = [f.path for f in system.get_file_info(FileSelector(inner)) if f.path.endswith(".parquet")]
    found = pa.concat_tables([pq.ParquetFile(system.open_input_file(f)).read(["row", "id", "text"]) for f in files])
    found = found.sort_by("row")
    ids = found.column("id").fill_null(NO_ID).to_numpy()
    return Chunk(number, found.column("row").to_numpy(), ids, found.column("text").to_pylist())


def each_chunk(store: ChunkStore, work: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on every chunk, one task for each."""
    numbers = store.frame.select("chunk").distinct()
    return with_replies(store, numbers.select("chunk", F.lit(None).cast("binary").alias("data")), lambda c, _: work(c), schema, every=False)


def with_replies(
    store: ChunkStore, replies: DataFrame, work: Callable[[Chunk, list[bytes]], Iterator[pa.RecordBatch]], schema: str,
    *, every: bool = True,
) -> DataFrame:
    """``work`` on each chunk with its replies (``chunk``, ``data``); ``every``: on chunks without replies as well."""
    path = store.path
    replies = replies.select("chunk", "data")
    if every:
        numbers = store.frame.select("chunk").distinct()
        replies = replies.unionByName(numbers.withColumn("data", F.lit(None).cast("binary")))

    def task(number: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from work(load_chunk(path, number), [d for d in rows.column("data").to_pylist() if d is not None])

    return by_key(replies, "chunk", task, schema)


def by_key(df: DataFrame, key: str, work: Callable[[int, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on the rows of each key, streamed by key in the shuffle's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            keys = batch.column(key).to_numpy()
            cuts = [0, *(np.nonzero(np.diff(keys))[0] + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                if current is not None and keys[low] != current:
                    yield from work(current, pa.Table.from_batches(held))
                    held = []
                current = int(keys[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from work(current, pa.Table.from_batches(held))

    # By a hash of the key: rows that are grouped by the key already would stay as they are, and adaptive execution
    # would join tasks by the size of the rows, which says nothing of the work.
    partitions = shuffle_partitions(df.sparkSession)
    return map_arrow(df.repartition(partitions, F.xxhash64(key)).sortWithinPartitions(key), run, schema)


def bucket_count(store: ChunkStore, per_bucket: int = 16 << 20) -> int:
    """Buckets for hashes: what falls on one stems from about ``per_bucket`` bytes of text."""
    return max(2 * shuffle_partitions(store.spark), -(-store.n_bytes // per_bucket))


# Packed arrays: byte planes, so that high bytes that are all zero cost nothing after compression.


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length (integers; 8-byte ones may be given as ``(array, bytes)`` to keep the low bytes)."""
    parts = [len(arrays[0][0] if isinstance(arrays[0], tuple) else arrays[0]).to_bytes(8, "little")]
    for array in arrays:
        array, width = array if isinstance(array, tuple) else (array, array.dtype.itemsize)
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.dtype.itemsize)
        parts.append(planes[:, :width].T.tobytes())
    return b"".join(parts)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    """The inverse; ``kinds`` are dtypes, or ``(dtype, bytes)``."""
    n, at, arrays = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        kind, width = kind if isinstance(kind, tuple) else (kind, np.dtype(kind).itemsize)
        planes = np.zeros((np.dtype(kind).itemsize, n), np.uint8)
        planes[:width] = np.frombuffer(data, np.uint8, width * n, at).reshape(width, n)
        arrays.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += width * n
    return arrays


def blob_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    buckets, chunks, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array(chunks, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "chunk", "data"]
    )


def split_by(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by key, the distinct keys and where each begins (with the end)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.concatenate(([0], np.nonzero(np.diff(ranked))[0] + 1)) if len(keys) else np.empty(0, np.int64)
    return order, ranked[first] if len(keys) else keys, np.append(first, len(keys)).astype(np.int64)
