"""Near-duplicates by SimHash, found through tables of Hamming distances to reference fingerprints (pivots).

A fingerprint has one or more words of 64 bits. Each word has a base pivot and 64 pivots that differ from it within one
unit of four bits. The distance to such a pivot, less the distance to the base, depends on that unit alone, and the
four pivots of a unit are independent: together they fix it. So the difference of two rows of the distance table bounds
their Hamming distance from below, and rows that agree on the coordinates of a group of units agree on those bits.

Pairs are looked for among fingerprints with equal coordinates on a group of units (a bucket), discarded when any
coordinate differs by more than the radius, and the survivors are verified on the fingerprints themselves.

* ``EXACT``: one word, radius 2. Four blocks of 16 bits; two flipped bits leave two blocks untouched, so the six pairs
  of blocks find every link. Buckets over ``bucket_rows`` are dealt again by the halves, then the quarters of their
  other blocks; after that a bucket has 8 free bits, 256 fingerprints at most. Nothing is lost and no task is large.
* ``by_sets()``: links at a Jaccard similarity of the shingle sets themselves, all of them, besides those of fingerprints.
  The same steps put texts into families (components at radius 2), within which ``ngram_join.py`` compares sets first; links
  between families, which fingerprints cannot find, follow from its token-group matrix. Families stay together where sets
  differ: fingerprints count every repeat of a shingle, sets none.

Only distinct fingerprints are compared, and a bucket yields a spanning forest of its links, never all pairs.
Null and blank texts have fingerprint zero, which is linked like any other; repeated rows share a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.llm import ngram_join
from chatterloom.llm.common import free_name, map_pandas, settled, store
from chatterloom.llm.components import components

_SEED = 42
_BYTE_LANES = np.uint64(0x0101010101010101)
_UNIT_BITS = 4  # a larger radius than this discards nothing by coordinates of one unit
_UNIT_MASKS = (0b0001, 0b0011, 0b0110, 0b1111)  # independent over the reals


@dataclass(frozen=True)
class Plan:
    """``words`` 64-bit words from shingles of ``shingle`` words; links at ``radius`` or fewer differing bits.

    ``percent``: links at this Jaccard similarity of the shingle sets, too.
    """

    shingle: int
    words: int
    radius: int
    bucket_rows: int = 256
    percent: int | None = None


EXACT = Plan(shingle=3, words=1, radius=2)


def by_sets(shingle: int = 5, percent: int = 80) -> Plan:
    """A plan that links texts whose shingle sets have this Jaccard similarity, and those that ``EXACT``'s radius links."""
    return Plan(shingle, EXACT.words, EXACT.radius, percent=percent)


# Fingerprints


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of the whole text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(len(words) - size + 1, 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), (ends[min(size, len(words)) - 1 :] - 1).tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], _SEED) for a, b in spans), np.uint64, n)


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set in each row: byte-wide lanes add up 255 values at a time."""
    words, n = values.shape
    counts = np.zeros((words, 8, 8), np.int64)  # word, byte, bit
    for at in range(0, n, 255 * 64):
        part = values[:, at : at + 255 * 64]
        padded = np.zeros((words, -(-part.shape[1] // 255) * 255), np.uint64)
        padded[:, : part.shape[1]] = part
        blocks = padded.reshape(words, -1, 255)
        for k in range(8):
            lanes = ((blocks >> np.uint64(k)) & _BYTE_LANES).sum(axis=2, dtype=np.uint64)
            counts[:, :, k] += lanes.view(np.uint8).reshape(words, -1, 8).sum(axis=1, dtype=np.int64)
    return counts.reshape(words, 64)


def _remixed(values: np.ndarray, words: int) -> np.ndarray:
    """The hashes, then other hashes of the same shingles for each further word."""
    number = np.arange(words, dtype=np.uint64)[:, None]
    mixed = (values ^ (number * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    mixed[0] = values
    return mixed


def fingerprint(text: str | None, plan: Plan) -> bytes:
    """The fingerprint, words big-endian: a bit is 1 if over half of the shingle hashes have it."""
    hashes = shingle_hashes(text, plan.shingle)
    if not len(hashes):
        return bytes(8 * plan.words)
    counts = np.zeros((plan.words, 64), np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += _bit_counts(_remixed(hashes[at : at + (1 << 16)], plan.words))
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8").astype(">u8").tobytes()


def fingerprints(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``fp`` (binary) of every row, stored."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "fp": [fingerprint(t, plan) for t in batch["text"]]})

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return store(map_pandas(narrow, work, f"id {kind}, fp binary"), "fingerprints")


# The distance table and its buckets


def pivots(words: int) -> np.ndarray:
    """``words`` rows of 65 references: the base, then four for each of the 16 units of a word."""
    base = np.random.default_rng(20240).integers(0, 2**63, (words, 1), dtype=np.uint64)
    masks = np.array([m << (4 * u) for u in range(16) for m in _UNIT_MASKS], np.uint64)
    return np.concatenate([base, base ^ masks], axis=1)


def distances(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Rows x words x 65: Hamming distance of each word to its references."""
    return np.bitwise_count(fps[:, :, None] ^ refs[None])


def _unit_codes(table: np.ndarray) -> np.ndarray:
    """Rows x (16 a word): the four relative distances of a unit in one number."""
    relative = table[:, :, 1:].astype(np.int64) - table[:, :, :1] + 4
    n, words, _ = relative.shape
    return (relative.reshape(n, words * 16, 4) * np.array([1, 9, 81, 729])).sum(axis=2)


def _level_groups(plan: Plan) -> list[list[tuple[int, ...]]]:
    """The groups of units that make the keys of each level (a level splits the buckets of the one before)."""
    levels, free = [], [((), tuple(range(16)))]
    for width in (4, 2, 1):
        level, following = [], []
        for fixed, rest in free:
            blocks = [rest[i : i + width] for i in range(0, len(rest), width)]
            for same in combinations(range(4), 2):
                held = fixed + tuple(u for b in same for u in blocks[b])
                level.append(held)
                following.append((held, tuple(u for b in range(4) if b not in same for u in blocks[b])))
        levels.append(level)
        free = following
    return levels


def _keys(codes: np.ndarray, group: tuple[int, ...], number: int) -> np.ndarray:
    mix = np.full(len(codes), number + 1, np.uint64)
    for unit in group:
        mix = (mix ^ codes[:, unit].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    return mix.view(np.int64)


def _as_words(fps, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(fps), ">u8").astype(np.uint64).reshape(-1, words)


def _bucket_rows(nodes: DataFrame, plan: Plan, level: int) -> DataFrame:
    """``key``, ``node``, ``fp`` for every bucket a fingerprint is in (``parent``: the group it was dealt by before)."""
    groups, refs = _level_groups(plan), pivots(plan.words)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            codes = _unit_codes(distances(_as_words(batch["fp"], plan.words), refs))
            for number, group in enumerate(groups[level]):
                mine = batch if level == 0 else batch[batch["group"] == number // 6]
                if not mine.empty:
                    picked = codes if level == 0 else codes[mine.index]
                    keys = _keys(picked, group, number)
                    yield pd.DataFrame({"key": keys, "group": number, "node": mine["node"], "fp": mine["fp"]})

    columns = ["node", "fp"] if level == 0 else ["node", "fp", "group"]
    return map_pandas(nodes.select(*columns), work, "key bigint, group int, node bigint, fp binary")


def forest(fps: np.ndarray, refs: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints (rows x words) of one bucket."""
    table = distances(fps, refs).reshape(len(fps), -1).astype(np.int16) if radius < _UNIT_BITS else None
    rest, edges = np.arange(len(fps)), []
    while len(rest) > 1:  # grows one tree at a time
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at, near = frontier.pop(), rest
            if table is not None:
                near = near[np.abs(table[near] - table[at]).max(axis=1) <= radius]
            near = near[np.bitwise_count(fps[near] ^ fps[at]).sum(axis=1) <= radius]
            edges += [(int(at), int(x)) for x in near]
            frontier += near.tolist()
            rest = np.setdiff1d(rest, near, assume_unique=True)
    return edges


def _bucket_edges(rows: DataFrame, plan: Plan) -> DataFrame:
    """Edges within buckets; rows of one key are together, ordered, in one partition."""
    refs = pivots(plan.words)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for nodes, fps in zip(batch["nodes"], batch["fps"], strict=True):
                found += [(nodes[a], nodes[b]) for a, b in forest(_as_words(fps, plan.words), refs, plan.radius)]
            yield pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    buckets = rows.groupBy("key").agg(F.collect_list(F.struct("node", "fp")).alias("members"))
    lists = buckets.select(F.col("members.node").alias("nodes"), F.col("members.fp").alias("fps"))
    return map_pandas(lists, work, "u bigint, v bigint")


def links(nodes: DataFrame, plan: Plan) -> DataFrame:
    """Edges ``u``, ``v`` over distinct fingerprints (``node``, ``fp``) that span the components of all links."""
    found, rows = [], _bucket_rows(nodes, plan, 0)
    last = len(_level_groups(plan)) - 1
    for level in range(last + 1):
        rows = store(rows, "buckets")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = store(rows.join(sizes, "key"), "shared")
        small = shared if level == last else shared.filter(F.col("n") <= plan.bucket_rows)
        found.append(store(_bucket_edges(small, plan), "links"))
        large = shared.filter(F.col("n") > plan.bucket_rows)
        if level == last or large.isEmpty():
            break
        rows = _bucket_rows(large, plan, level + 1)
    return reduce(DataFrame.unionByName, found)


def near_components(rows: DataFrame, plan: Plan) -> DataFrame:
    """``id``, ``fp``, ``component_id`` for every row of ``fingerprints``: the smallest id reachable."""
    known = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    nodes = store(known.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = components(links(nodes, plan))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = store(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = store(rooted.join(least, "root").select("fp", "component_id"), "labels")
    # Both sides are stored: plain exchanges, which adaptive execution can split at a fingerprint of many rows.
    return rows.join(labels.hint("merge"), "fp")


def _joined(families: DataFrame, groups: DataFrame) -> DataFrame:
    """``id``, ``component_id`` (the smallest there) of rows that have the ``family`` or the ``component_id`` in common."""
    both = store(families.join(groups.hint("merge"), "id").select("id", "family", "component_id"), "both")
    pairs = store(both.select("family", "component_id").distinct(), "pairs")
    least = pairs.groupBy("family").agg(F.min("component_id").alias("v"))
    met = pairs.join(store(least, "least").hint("merge"), "family").select(F.col("component_id").alias("u"), "v")
    roots = store(components(met), "roots").withColumnRenamed("node", "component_id")
    joined = both.join(roots.hint("merge"), "component_id", "left")
    return joined.select("id", F.coalesce("root", "component_id").alias("component_id"))


def _kept_rows(docs: DataFrame, plan: Plan, row: str, id_col: str, text_col: str) -> DataFrame:
    found = settled(lambda: near_components(fingerprints(docs, plan, row, text_col), plan).drop("fp"), "families")
    if plan.percent is not None:
        families = found.withColumnRenamed("component_id", "family")
        groups = ngram_join.similar_groups(docs, ngram_join.Rules(plan.shingle, plan.percent), row, text_col, families)
        # Texts without words are copies of each other; rows have no negative numbers.
        component = F.when(F.col("n_shingles") == 0, -1).otherwise(F.col("component_id"))
        found = _joined(families, groups.select("id", component.alias("component_id")))
    ids = docs.select(F.col(row).alias("id"), F.struct(F.col(id_col).isNull(), id_col, row).alias("rank"))
    first = found.join(ids, "id").groupBy("component_id").agg(F.min("rank").alias("rank"))
    return first.select(F.col(f"rank.{row}").alias(row))


def keep_one(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest id.

    Rows that repeat the id and the text of the one that stays count as one document: one of them is returned.
    """
    row = free_name(docs.columns, "simhash_row")
    docs = store(docs.withColumn(row, F.monotonically_increasing_id()), "batch")
    keep = settled(lambda: _kept_rows(docs, plan, row, id_col, text_col), "kept")
    return docs.join(keep, row, "left_semi").drop(row)
