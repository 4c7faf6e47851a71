"""Alignment of two tokenizers over the same texts: which tokens cover the same bytes.

Both tokenizers cut a space and the text into tokens; where a token of A and one of B end at the same byte, both
sequences are cut into groups, and an A token is linked with every B token whose bytes overlap its own.

The merge runs in lockstep: one state vector holds the A and B pointers of all documents of a batch, and each step
compares the two token ends of every document at once, emits a link (and a cut where they are equal) and advances the
pointer that is behind, or both. Finished documents are taken out of the vector. A long document has several places in
the vector, one for each stretch between cuts that a look at some of its tokens has found, so that the number of steps
does not grow with the longest text.

Counts over the corpus: an id pair's count is the number of documents that hold it linked. Documents are gathered into
chunks of bounded bytes; a chunk has one dictionary of its id pairs, which is all that is shuffled: pairs are summed
over chunks, and each chunk gets back the counts of its own pairs.

Null and empty texts, and texts that a tokenizer does not give back byte by byte (it normalises, or knows no byte
tokens), have no tokens: zeros and empty lists. Texts of any length are read whole, in parts that are cut at single spaces
between printing characters, where neither tokenizer merges: tokens of a part that was seen before are known. Repeated
rows and null ids are rows of their own. No rows give no rows. Names of other columns don't matter.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm.common import map_arrow, store

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"

_KNOWN = 1 << 18  # parts of texts whose tokens a worker remembers
_LINE = 2048  # bytes of parts that are encoded in one line, about
_BATCH = 2 << 20  # bytes of texts that are merged at once, or one text
_STRIDE = 128  # tokens between the looks for a cut
#: A single space between two printing characters: a token of either side can begin with it, none goes on over it.
_BETWEEN = re.compile(r"(?<=[!-~]) (?=[!-~])")


# Tokenizers


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers: A of byte-level merges (JSON), B of pieces with byte tokens (a model file)."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a.decode()), SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True
        alphabet = _byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(alphabet[c] for c in n) if all(c in alphabet for c in n) else n.encode() for n in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.forget()
        self.a_written, self.b_written = _decimals(len(names), b",|"), _decimals(len(pieces), b",;\0")

    def forget(self) -> None:
        """No part is known: its number is its place in bounds of ids and in ``usable``."""
        self.known: dict[str, int] = {}
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.bounds = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.usable = np.empty(0, bool)

    def _encoded(self, lines: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        by_a = [e.ids for e in self.a.encode_batch_fast([" " + x for x in lines], add_special_tokens=False)]
        return by_a, self.b.encode(lines, num_threads=1)

    def _learn(self, parts: list[str]) -> None:
        """Encodes parts that are new, many in a line, as their tokens are the same there."""
        sizes = np.array([1 + len(p.encode("utf-8", "surrogatepass")) for p in parts], np.int64)
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(_LINE, int(sizes.sum()) + _LINE, _LINE))
        cuts = np.unique(np.concatenate(([0], cuts + 1, [len(parts)])).clip(max=len(parts)))
        held = [(parts[a:b], sizes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        while held:  # a line whose bytes don't come back is tried part by part
            lines = [" ".join(p) for p, _ in held]
            again = []
            ids, bounds, usable, learnt = [[], []], [[], []], [], []
            counts = [self.bounds[side][-1] for side in range(2)]
            for line, (own, widths), *both in zip(lines, held, *self._encoded(lines), strict=True):
                given = b" " + line.encode("utf-8", "surrogatepass")
                tables = (self.a_bytes, self.b_bytes)
                same = all(b"".join(map(t.__getitem__, x)) == given for t, x in zip(tables, both, strict=True))
                if not same and len(own) > 1:
                    again += [([p], widths[k : k + 1]) for k, p in enumerate(own)]
                    continue
                ends = np.cumsum(widths)
                for side, (one, size) in enumerate(zip(both, (self.a_sizes, self.b_sizes), strict=True)):
                    one = np.array(one if same else [], np.int32)
                    at = np.searchsorted(np.cumsum(size[one]), ends) + 1 if same else np.zeros(1, np.int64)
                    ids[side].append(one)
                    bounds[side].append(counts[side] + at)
                    counts[side] += len(one)
                usable += [same] * len(own)
                learnt += own
            for side in range(2):
                self.ids[side] = np.concatenate([self.ids[side], *ids[side]])
                self.bounds[side] = np.concatenate([self.bounds[side], *bounds[side]])
            self.usable = np.append(self.usable, np.array(usable, bool))
            self.known.update(zip(learnt, range(len(self.known), len(self.known) + len(learnt)), strict=True))
            held = again

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all tokens by A, the texts' bounds in them, and the same by B.

        A text has none if the bytes of its tokens are not those of a space and the text.
        """
        split = [_BETWEEN.split(text) if text else [] for text in texts]
        if len(self.known) > _KNOWN:
            self.forget()
        self._learn(list(dict.fromkeys(part for parts in split for part in parts if part not in self.known)))
        own = np.fromiter((self.known[part] for parts in split for part in parts), np.int64)
        ends = np.cumsum([0, *(len(parts) for parts in split)])
        bad = np.concatenate(([0], np.cumsum(~self.usable[own])))
        own = own[np.repeat(np.diff(bad[ends]) == 0, np.diff(ends))]
        ends = np.cumsum(np.concatenate(([0], np.where(np.diff(bad[ends]) == 0, np.diff(ends), 0))))
        out = []
        for ids, bounds in zip(self.ids, self.bounds, strict=True):
            counts = bounds[own + 1] - bounds[own]
            before = np.concatenate(([0], np.cumsum(counts)))
            places = np.repeat(bounds[own] - before[:-1], counts) + np.arange(before[-1])
            out += [ids[places].astype(np.int64), before[ends]]
        return tuple(out)


def _decimals(count: int, separators: bytes) -> np.ndarray:
    """Ids in decimal with each separator after them (rows: separators), as fixed-width bytes."""
    width = len(str(count)) + 1
    return np.array([[str(i).encode() + bytes([s]) for i in range(count)] for s in separators], f"S{width}")


_LOADED: dict[bytes, Pair] = {}


def _load(key: bytes, sent) -> Pair:
    """Once a worker: the settings of a tokenizer don't survive pickling."""
    if key not in _LOADED:
        _LOADED[key] = Pair(*sent.value)
    return _LOADED[key]


def _shared(spark: SparkSession, a_path: str, b_path: str):
    """The vocabulary files (a few MB, whatever the corpus) for all tasks: a function that loads them."""
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            contents.append(file.read())
    return partial(_load, sha256(b"".join(contents)).digest(), spark.sparkContext.broadcast(contents))


# The merge


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, i: np.ndarray, j: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A and B places) and cuts (last A and B places of a group) of all stretches.

    A stretch begins at token ``i`` of A and ``j`` of B and ends with token ``stop - 1`` of A, at whose end one of B
    ends as well. Ends are byte offsets that grow through all tokens.
    """
    links_i, links_j, cuts_i, cuts_j = [], [], [], []
    while len(i):
        a, b = ends_a[i], ends_b[j]
        links_i.append(i)
        links_j.append(j)
        both = a == b
        cuts_i.append(i[both])
        cuts_j.append(j[both])
        i, j = i + (a <= b), j + (b <= a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    empty = [np.empty(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (links_i, links_j, cuts_i, cuts_j))


@dataclass
class Aligned:
    """A batch: ids of all tokens, the documents' bounds, links in order and group ends."""

    a: np.ndarray
    b: np.ndarray
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    ends: np.ndarray = field(repr=False)  # byte offsets of A tokens' ends, through all documents

    def per_document(self, places: np.ndarray) -> np.ndarray:
        """Bounds of each document in a sorted list of A places."""
        return np.searchsorted(places, self.bounds_a)


def align_batch(pair: Pair, texts: list[str | None]) -> Aligned:
    a, bounds_a, b, bounds_b = pair.encode(texts)
    ends_a, ends_b = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
    looks = np.arange(_STRIDE, len(a), _STRIDE)  # every so many tokens: is the end before it one of B as well?
    places = np.searchsorted(ends_b, ends_a[looks - 1])
    common = ends_b[places] == ends_a[looks - 1]
    full = np.nonzero(np.diff(bounds_a))[0]
    i = np.union1d(bounds_a[full], looks[common])
    j = np.searchsorted(ends_b, ends_a[i - 1]) + 1
    j[i == 0] = 0
    stop = np.append(i[1:], len(a))[: len(i)]
    links_a, links_b, cuts_a, cuts_b = lockstep(ends_a, ends_b, i, j, stop)
    order = np.argsort(links_a + links_b, kind="stable")  # each step adds one or two to it
    return Aligned(a, b, bounds_a, bounds_b, links_a[order], links_b[order], np.sort(cuts_a), np.sort(cuts_b), ends_a)


def written_groups(pair: Pair, batch: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document."""
    n_a, n_b = len(batch.a), len(batch.b)
    last_a, last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    last_a[batch.cuts_a], last_b[batch.cuts_b] = 1, 1
    last_b[batch.bounds_b[1:][np.diff(batch.bounds_b) > 0] - 1] = 2  # nothing after a document's last id
    group_a = np.searchsorted(batch.cuts_a, np.arange(n_a))
    group_b = np.searchsorted(batch.cuts_b, np.arange(n_b))
    before_b = np.concatenate(([0], batch.cuts_b + 1))
    width = max(pair.a_written.itemsize, pair.b_written.itemsize)
    line = np.empty(n_a + n_b, f"S{width}")
    line[np.arange(n_a) + before_b[group_a]] = pair.a_written[last_a, batch.a]
    line[np.arange(n_b) + (batch.cuts_a + 1)[group_b]] = pair.b_written[last_b, batch.b]
    grid = line.view(np.uint8).reshape(-1, width)
    ends = np.concatenate(([0], np.cumsum((grid != 0).sum(axis=1))))[batch.bounds_a + batch.bounds_b]
    whole = grid[grid != 0].tobytes()
    return [whole[low:high] for low, high in zip(ends, ends[1:], strict=False)]


def _batches(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts in batches of bounded bytes, with the place of the first."""
    texts, first, held = [], 0, 0
    for at, text in enumerate(column.to_pylist()):
        if texts and held + len(text or "") > _BATCH:
            yield first, texts
            texts, first, held = [], at, 0
        texts.append(text)
        held += len(text or "")
    if texts:
        yield first, texts


def _lists(values: np.ndarray, bounds: np.ndarray, kind=pa.int32()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def align(docs: DataFrame, a_path: str = f"{FOLDER}/{BYTE_BPE}", b_path: str = f"{FOLDER}/{PIECE_BPE}", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id``, ``a_ids``, ``b_ids``, the links (``link_a``, ``link_b``: places in these lists, in order) and
    the groups (``group_a``, ``group_b``: the place after each group's last token; ``group_end``: its last byte's end)."""
    load = _shared(docs.sparkSession, a_path, b_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load()
        for batch in batches:
            for first, texts in _batches(batch.column("text")):
                found = align_batch(pair, texts)
                links, groups = (found.per_document(x) for x in (found.links_a, found.cuts_a))
                low_a, low_b = found.bounds_a[:-1], found.bounds_b[:-1]
                before = np.concatenate(([0], found.ends))[low_a]  # bytes of the documents before
                of_links, of_groups = np.diff(links), np.diff(groups)
                columns = {
                    "id": batch.column("id").slice(first, len(texts)),
                    "a_ids": _lists(found.a, found.bounds_a),
                    "b_ids": _lists(found.b, found.bounds_b),
                    "link_a": _lists(found.links_a - np.repeat(low_a, of_links), links),
                    "link_b": _lists(found.links_b - np.repeat(low_b, of_links), links),
                    "group_a": _lists(found.cuts_a + 1 - np.repeat(low_a, of_groups), groups),
                    "group_b": _lists(found.cuts_b + 1 - np.repeat(low_b, of_groups), groups),
                    "group_end": _lists(found.ends[found.cuts_a] - np.repeat(before, of_groups), groups, pa.int64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    lists = ", ".join(f"{name} array<int>" for name in ("a_ids", "b_ids", "link_a", "link_b", "group_a", "group_b"))
    return map_arrow(narrow, work, f"id bigint, {lists}, group_end array<bigint>")


# Counts over the corpus


_CHUNKS = (
    "chunk bigint, pair array<bigint>, n_docs array<int>, code array<int>, times array<int>, "
    "docs array<struct<id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string, n_pairs: int>>"
)


def _chunked(docs: DataFrame, load, chunk_bytes: int) -> DataFrame:
    """One row per chunk of documents, stored: the dictionary of its id pairs, and its documents' pairs as codes in it."""
    kinds = pa.list_(
        pa.struct([("id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("n_pairs", pa.int32())])
    )

    def of_batch(pair: Pair, ids: list, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        found = align_batch(pair, texts)
        width_b = len(pair.b_bytes)
        links, groups = (np.diff(found.per_document(x)) for x in (found.links_a, found.cuts_a))
        place = np.repeat(np.arange(len(texts)), links)
        ids_of = found.a[found.links_a] * width_b + found.b[found.links_b]
        keys, times = np.unique(place * (len(pair.a_bytes) * width_b) + ids_of, return_counts=True)
        owner, pairs = np.divmod(keys, len(pair.a_bytes) * width_b)
        n_pairs = np.bincount(owner, minlength=len(texts))
        digests = [sha256(line).hexdigest() if line else "" for line in written_groups(pair, found)]
        n_a, n_b = np.diff(found.bounds_a), np.diff(found.bounds_b)
        columns = (ids, n_a.tolist(), n_b.tolist(), groups.tolist(), links.tolist(), digests, n_pairs.tolist())
        return list(zip(*columns, strict=True)), pairs, times

    names = [f.name for f in kinds.value_type]

    def row(number: int, held: list[tuple[list[tuple], np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs, code, n_docs = np.unique(np.concatenate([p for _, p, _ in held]), return_inverse=True, return_counts=True)
        docs = [dict(zip(names, d, strict=True)) for found, _, _ in held for d in found]
        lists = [_lists(x, np.array([0, len(x)]), kind) for x, kind in ((pairs, pa.int64()), (n_docs, pa.int32()), (code, pa.int32()), (np.concatenate([t for _, _, t in held]), pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, pa.array([docs], kinds)], names=["chunk", "pair", "n_docs", "code", "times", "docs"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held, size, count, task = load(), [], 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column("row")[0].as_py() >> 33 << 20
            ids = batch.column("id").to_pylist()
            for first, texts in _batches(batch.column("text")):
                held.append(of_batch(pair, ids[first : first + len(texts)], texts))
                size += sum(len(t or "") for t in texts)
                if size >= chunk_bytes:
                    yield row(task + count, held)
                    held, size, count = [], 0, count + 1
        if held:
            yield row(task + count, held)

    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col("id"), F.col("text"))
    return store(map_arrow(narrow, work, _CHUNKS), "aligned")


def link_counts(
    docs: DataFrame, a_path: str = f"{FOLDER}/{BYTE_BPE}", b_path: str = f"{FOLDER}/{PIECE_BPE}", id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    """Per document: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest of
    their A id in the corpus), ``count_sum`` (of counts over links), ``groups_sha256``."""
    load = _shared(docs.sparkSession, a_path, b_path)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chunks = _chunked(narrow, load, chunk_bytes)
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("pair", "n_docs")).alias("place", "p")).select("chunk", "place", "p.pair", "p.n_docs")
    counts = store(pairs.groupBy("pair").agg(F.sum("n_docs").alias("count")), "counts")
    a_id = F.floor(F.col("pair") / F.lit(len(load().b_bytes))).cast("bigint")
    most = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("most"))  # as many rows as A has ids, at most
    known = counts.withColumn("a", a_id).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    # Every chunk asks for the pairs of its dictionary; the answers of a chunk are as many.
    asked = pairs.select("chunk", "place", "pair").join(store(known, "known").hint("merge"), "pair")
    answers = asked.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("place", "count", "best"))).alias("answers"))
    answers = answers.select("chunk", F.col("answers.count").alias("count"), F.col("answers.best").alias("best"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                code, times, count, best = (one.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("code", "times", "count", "best"))
                found = one.column("docs").flatten()
                ends = np.concatenate(([0], np.cumsum(found.field("n_pairs").to_numpy())))
                code, times = code.astype(np.int64), times.astype(np.int64)
                totals = (np.diff(np.concatenate(([0], np.cumsum(times * x[code])))[ends]) for x in (best.astype(np.int64), count))
                fields = [found.field(n) for n in ("id", "n_a", "n_b", "n_groups", "n_links")]
                arrays = [*fields, *map(pa.array, totals), found.field("groups_sha256")]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    # A chunk without any pair has no answers.
    joined = chunks.select("chunk", "code", "times", "docs").join(answers.hint("merge"), "chunk", "left")
    joined = joined.withColumn("count", F.coalesce("count", F.array().cast("array<bigint>")))
    joined = joined.withColumn("best", F.coalesce("best", F.array().cast("array<boolean>")))
    return map_arrow(joined, sums, "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
