"""Benchmark decontamination with suffix arrays over the training corpus.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. The corpus is cut into shards: runs
of whole documents of about ``shard_bytes``, each in one task, so nothing is shuffled. A shard's suffix array lists the
word positions in the order of the words that follow them. Every suffix of every benchmark item is looked up by binary
search, word by word: the last range that is not empty gives the longest verbatim match and its places.

A window is 13 consecutive words of an item, or the whole item if it is shorter (but not empty). A document word inside
any occurrence of a window is hit. A document is contaminated when ``n_hit > 0`` and ``20 * n_hit >= n_words``.

The suffix array leaves out suffixes that no item can match in a whole window: a word that no item has ends a run, and
runs shorter than the shortest window are left out. That changes no result.

The benchmark is the stated query set. It goes to the tasks in blocks of at most ``block_words`` words, one pass over
the corpus for each block; the passes are merged by document. Null texts have no words, and an item without an id or
without words is none. Items with one id count once. Rows that repeat are judged each for itself. Output columns replace
columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.llm.common import free_name, map_arrow, store, without

WINDOW = 13
# On UTF-8: bytes of other than ASCII characters are all inside words, and ``lower`` of bytes changes A-Z alone.
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
VERDICT = ("n_words", "n_hit", "n_items", "items", "longest_match", "matches")
_SPAN = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])


def words(text: bytes | None) -> list[bytes]:
    return _WORD.findall((text or b"").lower())


class TestBlock:
    """Items of one block: their words as numbers, and one query for each suffix that starts a window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.ids = [item for item, _ in items]
        self.codes: dict[bytes, int] = {}
        number, at, item, length, room = [], [], [], [], []
        for i, (_, its) in enumerate(items):
            start, need = len(number), min(window, len(its))
            number += [self.codes.setdefault(w, len(self.codes) + 1) for w in its]
            for k in range(len(its) - need + 1):
                at.append(start + k)
                item.append(i)
                length.append(need)
                room.append(len(its) - k)
        self.words = np.array([*number, 0], np.int32)
        self.at, self.item = np.array(at, np.int64), np.array(item, np.int64)
        self.length, self.room = np.array(length, np.int64), np.array(room, np.int64)
        self.first = np.concatenate(([0], np.cumsum([len(its) for _, its in items])))
        self.shortest = int(self.length.min()) if len(length) else 0


def suffix_array(codes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the words that follow, by prefix doubling up to at least ``depth`` words.

    Code 0 ends a run; it ranks lowest.
    """
    rank, width = codes.astype(np.int64), 1
    while width < depth:
        following = np.zeros_like(rank)
        following[:-width] = rank[width:]
        _, rank = np.unique(rank * (int(following.max(initial=0)) + 1) + following, return_inverse=True)
        width *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def _narrow(codes: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray):
    """The part of each range [low, high) of the suffix array whose word at ``depth`` is the wanted one: two bisections."""

    def bisect(strict: bool) -> np.ndarray:
        left, right = low.copy(), high.copy()
        while (open_ := left < right).any():
            middle = (left + right) >> 1
            word = codes[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(codes) - 1)]
            up = (word < wanted) if strict else (word <= wanted)
            left, right = np.where(open_ & up, middle + 1, left), np.where(open_ & ~up, middle, right)
        return left

    return bisect(True), bisect(False)


def search(codes: np.ndarray, order: np.ndarray, tests: TestBlock, full: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Queries, with their range in the suffix array, at each depth: (depth, query, low, high).

    ``full`` is the depth up to which the suffix array is ordered; every window is shorter.
    """
    query = np.arange(len(tests.at))
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(order), np.int64)
    for depth in range(full):
        alive = tests.room[query] > depth
        query, low, high = query[alive], low[alive], high[alive]
        low, high = _narrow(codes, order, low, high, depth, tests.words[tests.at[query] + depth])
        alive = low < high
        query, low, high = query[alive], low[alive], high[alive]
        if not len(query):
            return
        yield depth + 1, query, low, high


def _extend(codes: np.ndarray, tests: TestBlock, query: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The full lengths of matches that are known to go on for ``length`` words."""
    length, going = length.copy(), np.arange(len(query))
    while len(going):
        q, at = query[going], length[going]
        more = at < tests.room[q]
        going, q, at = going[more], q[more], at[more]
        spot = place[going] + at
        same = (spot < len(codes)) & (codes[np.minimum(spot, len(codes) - 1)] == tests.words[tests.at[q] + at])
        going = going[same]
        length[going] += 1
    return length


def match_shard(texts: list[bytes | None], tests: TestBlock, window: int = WINDOW) -> list[tuple]:
    """Per document: n_words, n_hit, item numbers, longest match, maximal matches (item, item word, doc word, words)."""
    lookup, counts, numbers = tests.codes.get, [], []
    for text in texts:
        found = words(text)
        counts.append(len(found))
        numbers.append(np.fromiter((lookup(w, 0) for w in found), np.int32, len(found)))
        numbers.append(np.zeros(1, np.int32))  # matches end with the document
    codes = np.concatenate(numbers)
    first = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))
    # Runs of words that items have, if long enough for a window, each with the 0 behind it.
    ends = np.nonzero(codes == 0)[0]
    length = np.diff(ends, prepend=-1) - 1
    kept = ends[length >= max(tests.shortest, 1)] if len(tests.at) else ends[:0]
    size = length[length >= max(tests.shortest, 1)] + 1 if len(kept) else kept
    back = np.repeat(kept - np.cumsum(size) + 1, size) + np.arange(size.sum())  # their places in the shard
    runs = codes[back]
    until = np.repeat(np.cumsum(size), size) - np.arange(len(runs)) - 1
    starts = np.nonzero(until >= tests.shortest)[0] if len(kept) else kept
    queries, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(starts):
        order = suffix_array(runs, starts, window)
        for depth, query, low, high in search(runs, order, tests, window):
            whole = tests.length[query] == depth
            spread = (high - low)[whole]
            queries.append(np.repeat(query[whole], spread))
            offset = np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
            places.append(back[order[np.repeat(low[whole], spread) + offset]])
    query, place = np.concatenate(queries), np.concatenate(places)
    span = _extend(codes, tests, query, place, tests.length[query])
    doc = np.searchsorted(first, place, "right") - 1
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + tests.length[query], -1)
    hit = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
    # Matches that no longer one holds: the words before differ.
    before = np.where(place > 0, codes[place - 1], 0)
    mine = np.where(tests.at[query] > tests.first[tests.item[query]], tests.words[tests.at[query] - 1], -1)
    maximal = before != mine
    by_doc = np.argsort(doc, kind="stable")
    cuts = np.searchsorted(doc[by_doc], np.arange(len(texts) + 1))
    result = []
    for d, n in enumerate(counts):
        found = by_doc[cuts[d] : cuts[d + 1]]
        items = np.unique(tests.item[query[found]])
        found = found[maximal[found]]
        rows = [
            (int(tests.item[query[m]]), int(tests.at[query[m]] - tests.first[tests.item[query[m]]]), int(place[m] - first[d]), int(span[m]))
            for m in found
        ]
        result.append((n, int(hit[first[d + 1] - 1] - hit[first[d]]), items, max((r[3] for r in rows), default=0), rows))
    return result


def _test_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[TestBlock]:
    """The benchmark in blocks; the driver holds one block (and one item over it) at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("binary")).toLocalIterator():
        its = words(row[1])
        if its and row[0] is not None:
            block.append((row[0], its))
            size += len(its)
        if size >= block_words:
            yield TestBlock(block)
            block, size = [], 0
    if block:
        yield TestBlock(block)


def _pass(docs: DataFrame, text_col: str, tests: TestBlock, shard_bytes: int, keep: list[str]) -> DataFrame:
    """One pass of a test block over the corpus: ``keep`` and the verdict columns, the hit words as spans in ``matches``."""

    def judged(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        found = match_shard(rows.column(text_col).cast(pa.binary()).to_pylist(), tests)
        out = rows.select(keep)
        spans = [[{"item_id": tests.ids[i], "item_word": a, "doc_word": b, "n_words": n} for i, a, b, n in f[4]] for f in found]
        for name, values in (
            ("n_words", pa.array([f[0] for f in found], pa.int64())),
            ("n_hit", pa.array([f[1] for f in found], pa.int64())),
            ("items", pa.array([[tests.ids[i] for i in f[2]] for f in found], pa.list_(pa.string()))),
            ("longest_match", pa.array([f[3] for f in found], pa.int64())),
            ("matches", pa.array(spans, pa.list_(_SPAN))),
        ):
            out = out.append_column(name, values)
        yield from out.combine_chunks().to_batches(max_chunksize=1024)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= shard_bytes:
                yield from judged(held)
                held, size = [], 0
        if held:
            yield from judged(held)

    columns = docs.select(*keep).schema.simpleString()[len("struct<") : -1]
    verdict = "n_words:bigint,n_hit:bigint,items:array<string>,longest_match:bigint,matches:array<struct<item_id:string,item_word:bigint,doc_word:bigint,n_words:bigint>>"
    picked = docs if text_col in keep else docs.select(*keep, text_col)
    return map_arrow(picked, work, f"{columns},{verdict}" if columns else verdict)


def judge(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, shard_bytes: int = 24 << 20, block_words: int = 1_000_000,
) -> DataFrame:
    """``keep`` (all columns by default) and, per document, the verdict columns and ``contaminated``."""
    keep = [c for c in (keep or docs.columns) if c.lower() not in {*VERDICT, "contaminated"}]
    blocks = _test_blocks(benchmark, item_col, item_text, block_words)
    first, second = next(blocks, TestBlock([])), next(blocks, None)
    if second is None:
        found = _pass(docs, text_col, first, shard_bytes, keep)
    else:
        found = _merged(docs, text_col, [first, second, *blocks], shard_bytes, keep)
    found = found.withColumn("items", F.array_sort(F.array_distinct("items")))
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return found.withColumn("n_items", F.size("items").cast("bigint")).withColumn("contaminated", contaminated)


def _merged(docs: DataFrame, text_col: str, blocks: list[TestBlock], shard_bytes: int, keep: list[str]) -> DataFrame:
    """Several passes, merged by document: the hit words are the union of all blocks' windows."""
    row = free_name(docs.columns, "contamination_row")
    docs = store(docs.withColumn(row, F.monotonically_increasing_id()), "corpus")
    passes = None
    for block in blocks:
        found = store(_pass(docs, text_col, block, shard_bytes, [row]), "pass")
        passes = found if passes is None else passes.unionByName(found)
    spans = F.flatten(F.collect_list("matches"))
    joined = passes.groupBy(row).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"),
        F.max("longest_match").alias("longest_match"), spans.alias("matches"),
    )
    # Spans in order, each counted as far as it goes beyond those before it.
    ordered = F.array_sort(F.transform("matches", lambda m: F.struct(m["doc_word"].alias("a"), (m["doc_word"] + m["n_words"]).alias("b"))))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    total = F.aggregate(
        ordered, start,
        lambda s, m: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("bigint"), m["b"] - F.greatest(m["a"], s["to"]))).alias("n"),
            F.greatest(s["to"], m["b"]).alias("to"),
        ),
    )
    return docs.join(joined.withColumn("n_hit", total["n"]), row).select(*keep, "n_words", "n_hit", "items", "longest_match", "matches")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    marked = without(docs, *VERDICT, "contaminated")
    lost = [c for c in docs.columns if c not in marked.columns]
    if not lost:
        return judge(docs, benchmark, **options).filter("not contaminated").select(*docs.columns)
    renamed = docs
    for c in lost:  # own columns that carry a verdict's name pass through under another
        renamed = renamed.withColumnRenamed(c, free_name(renamed.columns, f"kept_{c}"))
    found = judge(renamed, benchmark, **options).filter("not contaminated")
    return found.select(*(F.col(a).alias(b) for a, b in zip(renamed.columns, docs.columns, strict=True)))


