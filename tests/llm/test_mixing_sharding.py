import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chatterloom.llm import mixing as M
from chatterloom.llm import sharding

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Water-filling, source by source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        target = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target | {s: most * sizes[s] for s in capped}
        capped |= over


def mixed(docs, **options):
    narrow = docs.select("doc_id", "source", M.word_count(F.col("text")).alias("size"))
    stored, found, row = M.allot(narrow, **options)
    return stored.select("doc_id", "source", row).join(found, row).collect()


def check(docs, rows, slack=1.0):
    assert len(rows) == docs.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(WORDS.findall(r.text or ""))
    wanted = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - wanted[r.source]) < 1e-6
        assert r.copies * r["size"] + r.part <= 2 * r["size"] and r.part <= r["size"]
        taken[r.source] += r.copies * r["size"] + r.part
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= slack, source


def test_targets_are_met_to_the_word(documents, edge_docs):
    for docs in (documents, edge_docs):
        check(docs, mixed(docs))


def test_two_levels_of_the_tree_and_reruns(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") * 7 % 50 + 1).cast("int")).alias("text"),
    )
    key = lambda rows: sorted((r.doc_id, r.copies, r.part) for r in rows)
    rows = mixed(docs)
    check(docs, rows)
    assert sum(r.part > 0 for r in rows) <= 5  # one document a source at most
    assert key(rows) == key(mixed(docs.repartition(7)))
    assert key(rows) != key(mixed(docs, seed=12))
    rounded = mixed(docs, last="round")
    assert all(r.part == 0 for r in rounded)
    check(docs, rounded, slack=50)


def test_copies_follow_probabilities(spark):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), (F.col("id") % 9 + 1).alias("size"))
    counts = Counter()
    for seed in range(6):
        _, found, row = M.allot(docs, seed=seed, last="round")
        counts.update({r[row]: r.copies for r in found.collect()})
    assert len(counts) == 60 and abs(sum(counts.values()) / (6 * 60) - 1.5) < 0.05


def test_limit_reshares_the_excess(spark):
    rows = [("a", 10), ("b", 1000), ("c", 500), (None, 3)]
    found = {r.source: r.target for r in M.targets(spark.createDataFrame(rows, "source string, size bigint")).collect()}
    wanted = brute_targets(dict(rows))
    assert found == pytest.approx(wanted) and found["a"] == 20


def test_mix_edges(spark, edge_docs, no_docs):
    out = M.mix(edge_docs)
    assert out.columns == edge_docs.columns
    known = Counter(map(str, edge_docs.collect()))
    assert all(n <= 2 * known[r] for r, n in Counter(map(str, out.collect())).items())
    assert M.mix(no_docs).collect() == [] and mixed(no_docs) == []


def test_native(edge_docs):
    plan = edge_docs._sc._jvm.PythonSQLUtils.explainString(M.mix(edge_docs)._jdf.queryExecution(), "simple")
    assert not re.search("Python|Pandas|Arrow", plan)


# Shards


def placed(docs, shards, **options):
    return sharding.shuffled(docs, shards, **options).collect()


@pytest.mark.parametrize(("shards", "bucket_bytes"), [(8, 32 << 20), (3, 1000)])
def test_rows_are_dealt_once_and_evenly(documents, shards, bucket_bytes):
    rows = placed(documents, shards, bucket_bytes=bucket_bytes)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in documents.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(shards))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    key = lambda found: sorted((r.doc_id, r.shard, r.slot) for r in found)
    assert key(rows) == key(placed(documents.repartition(5), shards, bucket_bytes=bucket_bytes))
    assert key(rows) != key(placed(documents, shards, bucket_bytes=bucket_bytes, seed=8))
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert sum(abs(a - b) for a, b in zip(order, order[1:], strict=False)) / len(order) > len(order) / 5  # no trace of the input's order


def test_shard_edges(spark, edge_docs, no_docs):
    rows = placed(edge_docs, 8)
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(8) for k in range(2)]
    assert len(sharding.shuffled(edge_docs, 8).columns) == len(edge_docs.columns)  # own "shard" replaced, "slot" added
    assert placed(no_docs, 8) == []
    path = sharding.write_shards(edge_docs, 4)
    back = spark.read.parquet(path)
    assert back.count() == edge_docs.count() and {r.shard for r in back.collect()} == set(range(4))
    few = placed(edge_docs.limit(2), 8)
    assert sorted(r.shard for r in few) == [0, 1]
