"""Similarity join of texts on their sets of word n-grams, exact, through a token-group matrix.

A document's tokens are the hashes (64 bits) of its distinct shingles. Two documents link at a Jaccard similarity of
``percent`` or more, in whole numbers: ``100 * both >= percent * union``.

1. A link needs ``percent`` of a set's tokens in common with another. Texts are stored in chunks; each chunk sends its
   distinct tokens (32 bits of them) to buckets, and a bit for each comes back: does any other chunk hold it? Documents
   with fewer common tokens than a link needs are out, with proof; only the sets of the others are stored.
2. Equal sets become one node. Tokens of one node alone are left out, the others put in order, rare ones first.
3. Similar nodes share a group: those of equal minima under two hashes, cut into groups of bounded rows and tokens.
   Within a group one product of the matrix of members and tokens gives all overlaps. Groups of one key meet through a
   leader each, in rounds, so that a large family of near copies becomes one component by work in proportion to it;
   then one node of each component meets others under another key.
4. Across groups: by the prefix rule, two linked sets share one of the first tokens of both, as many as their sizes and
   the least overlap allow. A row of the token-group matrix is a token with the groups whose members hold it there. A
   document and a group that meet in it, and are not one component yet, are bounded: the tokens of the document in the
   group's union must reach the least overlap with the group's smallest set. Only groups that qualify are opened.

A caller that knows families of texts that may be similar (``simhash.py``: components of fingerprints) gives them: the
nodes of a family meet under the minima of all its tokens. Families of equal minima share groups, as most families are of
one node: a group of the matrix for each would make pairs of groups of all near copies that edits have set apart.

No step caps or samples anything. Links within a component that is known already are not looked for, as they change no
component.

Null and blank texts have no tokens and no links. Of equal ids, each row is a document; a null id is larger than any
other, and a component without another id has a null one. No rows give no rows; names of other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterloom.llm import chunks as C
from chatterloom.llm.common import map_arrow, settled, store
from chatterloom.llm.components import components

_SEED = 42
_STEP = 1.05  # ratio of one class of sizes to the next


@dataclass(frozen=True)
class Rules:
    """``size`` words a shingle, links at ``percent``; a group has some ``group_rows`` members and ``group_tokens``.

    Nodes meet under ``keys`` keys before groups do: this changes the work, not the result.
    """

    size: int = 4
    percent: int = 85
    group_rows: int = 64
    group_tokens: int = 1 << 18
    keys: int = 2

    def least(self, n, m):
        """The overlap that sets of these sizes need: of both sizes as numbers, arrays or columns."""
        return -((-self.percent * (n + m)) // (100 + self.percent))


# Tokens


def tokens(text: bytes, size: int) -> np.ndarray:
    """The hashes of the distinct shingles, sorted."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), _SEED + len(words))], np.uint64)
    own = np.fromiter((digest(w, _SEED) for w in words), np.uint64, len(words))
    n = len(words) - size + 1
    mix = np.zeros(n, np.uint64)
    for k in range(size):
        mix = (mix ^ own[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(32)
    mix *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(mix ^ (mix >> np.uint64(32)))


def _spread(sets: list[np.ndarray], n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens of a chunk, their counts, and their order by bucket: buckets, where they begin, low bits."""
    distinct, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
    order, buckets, cuts = C.split_by((distinct >> np.uint64(32)) % np.uint64(n_buckets))
    return distinct, counts, order, buckets, cuts


def _common_tokens(chunks: C.ChunkStore, rules: Rules) -> DataFrame:
    """``row``, ``id``, ``n`` of every document, with the digest ``fp`` and ``tokens`` of those that may have a link; stored."""
    n_buckets = C.bucket_count(chunks)

    def send(chunk: C.Chunk) -> Iterator[pa.RecordBatch]:
        distinct, _, order, buckets, cuts = _spread([tokens(t, rules.size) for t in chunk.texts], n_buckets)
        low = distinct.astype(np.uint32)[order]
        yield C.blob_rows([(int(b), chunk.number, C.pack(low[x:y])) for b, x, y in zip(buckets, cuts, cuts[1:], strict=False)])

    def answer(bucket: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sent = [C.unpack(data, np.uint32)[0] for data in rows.column("data").to_pylist()]
        _, which, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        bits = np.split(counts[which] > 1, np.cumsum([len(x) for x in sent])[:-1])
        data = [bucket.to_bytes(8, "little") + np.packbits(x).tobytes() for x in bits]
        yield pa.RecordBatch.from_arrays([rows.column("chunk").combine_chunks(), pa.array(data, pa.binary())], names=["chunk", "data"])

    def judge(chunk: C.Chunk, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        sets = [tokens(t, rules.size) for t in chunk.texts]
        distinct, counts, order, buckets, cuts = _spread(sets, n_buckets)
        common, spans = counts > 1, {int(b): (x, y) for b, x, y in zip(buckets, cuts, cuts[1:], strict=False)}
        for reply in replies:
            x, y = spans[int.from_bytes(reply[:8], "little")]
            common[order[x:y]] |= np.unpackbits(np.frombuffer(reply, np.uint8, offset=8), count=y - x).astype(bool)
        kept, size = [], 0
        for at, own in enumerate(sets):
            enough = len(own) and 100 * int(common[np.searchsorted(distinct, own)].sum()) >= rules.percent * len(own)
            kept.append(own.view(np.int64) if enough else None)
            size += len(own) if enough else 0
            if size > 1 << 20 or at == len(sets) - 1:
                part = slice(at + 1 - len(kept), at + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chunk.rows[part]),
                        pa.array(chunk.ids[part], mask=chunk.ids[part] == C.NO_ID),
                        pa.array([len(s) for s in sets[part]], pa.int64()),
                        pa.array([None if k is None else xxhash.xxh3_128_digest(k.tobytes()) for k in kept], pa.binary()),
                        pa.array(kept, pa.list_(pa.int64())),
                    ],
                    names=["row", "id", "n", "fp", "tokens"],
                )
                kept, size = [], 0

    sent = C.each_chunk(chunks, send, C.BLOBS)
    replies = C.by_key(sent, "bucket", answer, "chunk bigint, data binary")
    return store(C.with_replies(chunks, replies, judge, "row bigint, id bigint, n bigint, fp binary, tokens array<bigint>"), "sets")


def _nodes(sets: DataFrame, known: DataFrame, rules: Rules, families: DataFrame | None) -> DataFrame:
    """``node``, ``n``, ``tokens`` (those of several nodes, rare ones first) of the sets that may have a link, and the
    ``family`` of the document each stands for; stored."""
    single = sets.select(F.col("row").alias("node"), "n", "tokens").join(known.select("node").hint("merge"), "node")
    each = store(single.select("node", "n", F.explode("tokens").alias("token")), "tokens")
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Both sides are stored: plain exchanges, which adaptive execution can split at a token of many nodes.
    common = each.join(store(counts, "counts").hint("merge"), "token")
    ordered = common.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    fit = ordered.filter(F.size("t") * 100 >= F.col("n") * rules.percent)
    fit = fit.select("node", "n", F.col("t.token").alias("tokens"))
    if families is not None:
        ids = sets.select(F.col("row").alias("node"), "n", "id").join(known.select("node").hint("merge"), "node")
        found = store(ids.join(families.hint("merge"), "id").select("node", "n", "family"), "of_nodes")
        fit = fit.join(found.hint("merge"), ["node", "n"])  # by both: the tokens are not shuffled again
    return store(fit, "nodes")


# Groups


def _least_hash(number: int) -> Column:
    return F.array_min(F.transform("tokens", lambda t: F.xxhash64(t, F.lit(number))))


def _cut(rows: DataFrame, rules: Rules, number: int, spots: DataFrame | None) -> tuple[DataFrame, int]:
    """Nodes (``key``, ``node``, ``n``, ``tokens``) with the group ``gid`` they are in; the most groups of a key.

    Keys of one ``spot`` (``spots``: ``key``, ``spot``) count as one key.
    """
    weights = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows_in"), F.sum(F.size("tokens")).alias("tokens_in"))
    spot = "key"
    if spots is not None:
        spot, weights = "spot", store(weights.join(spots.hint("merge"), "key"), "weights")
        whole = weights.groupBy("spot").agg(F.sum("rows_in").alias("rows_in"), F.sum("tokens_in").alias("tokens_in"))
        weights = weights.select("key", "spot").join(store(whole, "spots").hint("merge"), "spot")
    blocks = F.ceil(F.greatest(F.col("rows_in") / rules.group_rows, F.col("tokens_in") / rules.group_tokens))
    blocks = F.least(blocks, F.ceil(F.col("rows_in") / 2))  # two sets of any size can be compared
    weights = store(weights.select(*dict.fromkeys(("key", spot)), blocks.alias("blocks")), "weights")
    dealt = rows.join(weights.hint("merge"), "key")
    gid = F.xxhash64(spot, F.pmod(F.xxhash64("node", F.lit(number)), F.col("blocks")))
    return store(dealt.select("key", gid.alias("gid"), "node", "n", "tokens"), "groups"), weights.agg(F.max("blocks")).first()[0] or 0


def overlaps(left: list[np.ndarray], right: list[np.ndarray], union: np.ndarray) -> np.ndarray:
    """Tokens in common of each set on the left with each on the right, in a union of tokens: a matrix product."""

    def matrix(sets: list[np.ndarray]) -> np.ndarray:
        held = np.zeros((len(sets), len(union)), np.float32 if len(union) < 1 << 24 else np.float64)
        for line, own in zip(held, sets, strict=True):
            places = np.minimum(np.searchsorted(union, own), len(union) - 1)
            line[places[union[places] == own]] = 1
        return held

    return (matrix(left) @ matrix(right).T).astype(np.int64)


def _linked(both: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (n[:, None] + m[None] - both)


def _sets_of(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(pa.compute.list_value_length(column).to_numpy())))
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _within(groups: DataFrame, rules: Rules) -> DataFrame:
    """``gid``, ``node``, ``root`` (a node of the group that links lead to), ``leader`` (one of the largest part); stored."""

    def roots(near: np.ndarray) -> np.ndarray:
        root = np.full(len(near), -1)
        for at in range(len(near)):
            if root[at] < 0:
                reached = np.zeros(len(near), bool)
                reached[at] = True
                while (more := near[reached].any(axis=0) | reached).sum() > reached.sum():
                    reached = more
                root[reached] = at
        return root

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                members = batch.column("members")[at : at + 1].flatten()
                sets, n, nodes = _sets_of(members.field("tokens")), members.field("n").to_numpy(), members.field("node").to_numpy()
                union = np.unique(np.concatenate(sets))
                root = roots(_linked(overlaps(sets, sets, union), n, n, rules.percent))
                leader = np.arange(len(nodes)) == np.bincount(root).argmax()
                gid = pa.array(np.full(len(nodes), batch.column("gid")[at].as_py()))
                yield pa.RecordBatch.from_arrays([gid, *map(pa.array, (nodes, nodes[root], leader))], names=["gid", "node", "root", "leader"])

    members = groups.groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("node", "n", "tokens"))).alias("members"))
    return store(map_arrow(members, work, "gid bigint, node bigint, root bigint, leader boolean"), "within")


def _minima(number: int) -> list[Column]:
    return [_least_hash(2 * number + 1), _least_hash(2 * number + 2)]


def _linked_by_key(nodes: DataFrame, rules: Rules, key: Column, spots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The groups of nodes by a key; edges ``u``, ``v`` within groups, and among the leaders of the groups of a key."""
    groups, blocks = _cut(nodes.withColumn("key", key), rules, 0, spots)
    level, found, edges, number = groups, _within(groups, rules), None, 0
    while True:
        new = found.filter("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        edges = new if edges is None else edges.unionByName(new)
        if blocks <= 1:
            return groups, edges
        number += 1
        leaders = level.join(found.filter("leader").select("node").hint("merge"), "node").drop("gid")
        level, blocks = _cut(leaders, rules, number, spots)
        found = _within(level, rules)


def _families(nodes: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The groups of all nodes by the first key, edges, and ``node``, ``root`` of those that the edges join.

    One node of each component meets others under further keys: what an edit of a least token has set apart comes
    together before groups are compared.
    """
    if "family" in nodes.columns:
        spots = nodes.groupBy(F.col("family").alias("key")).agg(F.xxhash64(*map(F.min, _minima(0))).alias("spot"))
        groups, edges = _linked_by_key(nodes, rules, F.col("family"), store(spots, "spots"))
    else:
        groups, edges = _linked_by_key(nodes, rules, F.xxhash64(*_minima(0)))
    roots = store(components(edges), "roots")
    for key in range(1, rules.keys):
        heads = nodes.join(roots.filter("node != root").select("node").hint("merge"), "node", "left_anti")
        edges = edges.unionByName(_linked_by_key(store(heads, "heads"), rules, F.xxhash64(*_minima(key)))[1])
        roots = store(components(edges), "roots")
    return groups, edges, roots


# Across groups


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(_STEP))).cast("int")


def _prefixes(groups: DataFrame, rules: Rules) -> DataFrame:
    """``token``, ``low``, ``high`` (classes of both sizes), ``node``, ``gid``, ``root``: where a partner must be met."""
    own, reach = _size_class(F.col("n")), int(np.ceil(np.log(100 / rules.percent) / np.log(_STEP)))
    # The smallest size of the other class, a little less so that rounding loses none.
    smallest = F.greatest(F.floor(F.pow(F.lit(_STEP), F.col("other")) - 1e-6), F.ceil(F.col("n") * rules.percent / 100 - 1e-6), F.lit(1))
    need = F.ceil(rules.percent * (F.col("n") + F.col("smallest")) / (100 + rules.percent) - 1e-6)
    rows = groups.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.greatest(F.col("own") - reach, F.lit(0)), F.col("own") + reach)))
    rows = rows.withColumn("smallest", smallest)
    taken = F.greatest(F.size("tokens") - need + 1, F.lit(0)).cast("int")
    rows = rows.withColumn("token", F.explode(F.slice("tokens", 1, taken)))
    return rows.select("token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "gid", "root")


def _candidates(groups: DataFrame, rules: Rules) -> DataFrame:
    """``gid``, ``other``: pairs of groups that may hold a link between two components."""
    spot = ["token", "low", "high"]
    # A row of the matrix: the groups whose members hold the token there, and whether these are of one root.
    matrix = _prefixes(groups, rules).groupBy(*spot, "gid").agg(F.min("root").alias("a"), F.max("root").alias("b"))
    matrix = store(matrix, "matrix")
    several = matrix.groupBy(spot).agg(F.min("a").alias("a"), F.max("b").alias("b")).filter("a != b").select(spot)
    matrix = store(matrix.join(store(several, "several").hint("merge"), spot, "left_semi"), "matrix")
    right = matrix.select(*spot, F.col("gid").alias("other"), F.col("a").alias("other_a"), F.col("b").alias("other_b"))
    one_root = (F.col("a") == F.col("b")) & (F.col("other_a") == F.col("other_b")) & (F.col("a") == F.col("other_a"))
    met = matrix.join(right.hint("merge"), spot).filter((F.col("gid") < F.col("other")) & ~one_root)
    return met.select("gid", "other").distinct()


def _across(groups: DataFrame, rules: Rules) -> DataFrame:
    """Edges ``u``, ``v`` between nodes of different groups and components; stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for at in range(batch.num_rows):
                left, right = (batch.column(name)[at : at + 1].flatten() for name in ("left", "right"))
                n, m, u, v = (side.field(name).to_numpy() for name in ("n", "node") for side in (left, right))
                roots, other_roots = left.field("root").to_numpy(), right.field("root").to_numpy()
                sets, others = _sets_of(left.field("tokens")), _sets_of(right.field("tokens"))
                union = np.unique(np.concatenate(others))
                bound = np.array([np.isin(s, union, assume_unique=True).sum() for s in sets], np.int64)
                open_to = (roots[:, None] != other_roots[None]).any(axis=1)
                fit = open_to & (bound >= rules.least(n, np.maximum(m.min(), -(-n * rules.percent // 100))))
                if not fit.any():
                    continue
                both = overlaps([s for s, f in zip(sets, fit, strict=True) if f], others, union)
                near = _linked(both, n[fit], m, rules.percent) & (roots[fit][:, None] != other_roots[None])
                x, y = np.nonzero(near)
                us.append(u[fit][x])
                vs.append(v[y])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    members = groups.groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("node", "n", "root", "tokens"))).alias("members"))
    members = store(members, "members")
    pairs = store(_candidates(groups, rules), "candidates")
    pairs = pairs.join(members.select("gid", F.col("members").alias("left")).hint("merge"), "gid")
    pairs = pairs.join(members.select(F.col("gid").alias("other"), F.col("members").alias("right")).hint("merge"), "other")
    return store(map_arrow(pairs.select("left", "right"), work, "u bigint, v bigint"), "across")


def _components(docs: DataFrame, rules: Rules, id_col: str, text_col: str, families: DataFrame | None) -> DataFrame:
    sets = _common_tokens(C.store_chunks(docs, id_col, text_col), rules)
    fit = sets.filter(F.col("fp").isNotNull())
    known = store(fit.groupBy("fp").agg(F.min("row").alias("node")), "known")
    nodes = _nodes(sets, known, rules, families)
    groups, edges, roots = _families(nodes, rules)
    rooted = groups.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = components(edges.unionByName(_across(store(rooted, "rooted"), rules)))
    labels = store(known.join(roots.hint("merge"), "node", "left").select("fp", F.coalesce("root", "node").alias("root")), "labels")
    of_rows = store(fit.select("row", "id", "fp").join(labels.hint("merge"), "fp").select("row", "id", "root"), "of_rows")
    least = store(of_rows.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    found = of_rows.join(least.hint("merge"), "root").select("row", "component_id", F.lit(True).alias("known"))
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    return sets.select("row", "id", "n").join(found.hint("merge"), "row", "left").select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def similar_groups(
    docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", families: DataFrame | None = None
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` (the smallest id that links reach) of every row.

    ``families``: ``id``, ``family`` (bigint) of every row, by ids that do not repeat; they change the work, not the result.
    """
    return settled(lambda: _components(docs, rules, id_col, text_col, families), "similar")
