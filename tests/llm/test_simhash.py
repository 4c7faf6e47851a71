import re

import numpy as np
import pytest
import xxhash

from chatterloom.llm import simhash as S


def brute_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius):
    above = list(range(len(ids)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                above[root(i)] = root(j)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) for i in range(len(ids))]


def found_rows(docs):
    found = S.near_components(S.fingerprints(docs, S.EXACT), S.EXACT).collect()
    return sorted(((r.id, int(r.fp.hex(), 16), r.component_id) for r in found), key=str)


def wanted_rows(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    comps = brute_components([r.doc_id for r in rows], fps, 2)
    return sorted(zip((r.doc_id for r in rows), fps, comps, strict=True), key=str)


def test_documents_equal_brute_force(documents):
    assert found_rows(documents) == wanted_rows(documents)


def test_edges(edge_docs, no_docs):
    short = edge_docs.filter("doc_id is null or doc_id not in (10, 11)")
    assert found_rows(short) == wanted_rows(short)
    assert found_rows(no_docs) == []


def _clusters(seed, free_bits, n):
    """Fingerprints that differ in few places, so that buckets are large and are dealt again."""
    rng = np.random.default_rng(seed)
    bits = rng.choice(64, free_bits, replace=False)
    base = int(rng.integers(0, 2**63))
    return sorted({base ^ sum(1 << int(b) for b in rng.choice(bits, rng.integers(0, 5), replace=False)) for _ in range(n)})


@pytest.mark.parametrize(("seed", "free_bits"), [(1, 60), (2, 12)])
def test_hot_buckets_lose_no_link(spark, seed, free_bits):
    fps = _clusters(seed, free_bits, 700)
    plan = S.Plan(shingle=3, words=1, radius=2, bucket_rows=40)
    rows = spark.createDataFrame([(i, f.to_bytes(8, "big")) for i, f in enumerate(fps)], "id bigint, fp binary")
    found = {r.id: r.component_id for r in S.near_components(rows, plan).collect()}
    assert [found[i] for i in range(len(fps))] == brute_components(list(range(len(fps))), fps, 2)


def test_pivot_bound_and_keys():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 2**63, (200, 1), dtype=np.uint64)
    table = S.distances(fps, S.pivots(1)).astype(int)[:, 0]
    true = np.bitwise_count(fps[:, 0][:, None] ^ fps[:, 0][None]).astype(int)
    bound = np.abs(table[:, None] - table[None]).max(axis=2)
    assert (bound <= true).all()
    # The coordinates of a unit fix its bits.
    base = S.pivots(1)[0, 0]
    units = np.array([[base ^ np.uint64(v << (4 * u))] for u in (0, 7, 15) for v in range(16)], np.uint64)
    codes = S._unit_codes(S.distances(units, S.pivots(1)))
    assert len({tuple(c) for c in codes.tolist()}) == 16 * 3 - 2


def test_keep_one_of_near_copies(spark, edge_docs, no_docs):
    words = [f"w{i * 7919 % 1000}" for i in range(300)]
    near = [(i, " ".join([*words[:k], "changed", *words[k + 1 :]])) for i, k in enumerate((10, 60, 150, 290))]
    far = [(9, " ".join(words[:150] + [f"v{i}" for i in range(150)])), (None, " ".join(words)), (12, "one of its own"), (12, "one of its own")]
    docs = spark.createDataFrame([(*r, "f", "k") for r in near + far], "doc_id bigint, text string, fp string, node string")
    kept = S.keep_one(docs, S.by_sets())
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9, 12]
    assert S.keep_one(no_docs, S.by_sets()).collect() == []
    kept = [r.doc_id for r in S.keep_one(edge_docs, S.by_sets()).collect()]
    assert 3 in kept and not {7, 4} & set(kept) and len([k for k in kept if k in (10, 11)]) == 1


def test_pairs_go_at_the_similarity_and_stay_below(spark):
    def pair(number, same, own):
        words = [f"p{number}w{i}" for i in range(same + 4)]
        return [" ".join([*words, *(f"p{number}{side}{i}" for i in range(own))]) for side in "ab"]

    at = [pair(i, 240, 30) for i in range(30)] + [pair(i, 8, 1) for i in range(30, 50)]  # exactly 0.8
    below = [pair(i, 239, 30) for i in range(50, 80)] + [pair(i, 7, 1) for i in range(80, 100)]  # 0.799, 0.778
    rows = [(2 * n + k, text) for n, both in enumerate(at + below) for k, text in enumerate(both)]
    kept = {r.doc_id for r in S.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), S.by_sets()).collect()}
    assert kept == {2 * n for n in range(100)} | {2 * n + 1 for n in range(50, 100)}


def test_keep_one_by_sets_compares_families_of_fingerprints_first(spark, monkeypatch):
    """Fingerprints, distance table, buckets and verification decide which sets meet first; their groups are the matrix's."""
    words = [f"w{i * 7919 % 1000}" for i in range(400)]
    texts = [" ".join(words + ["x"] * i) for i in range(4)] + [" ".join(words[::-1] + ["x"] * i) for i in range(4)] + [None, " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    linked, groups = [], []

    def links(nodes, plan, of=S.links):
        linked.append((nodes.count(), plan))
        return of(nodes, plan)

    def families(nodes, rules, of=S.ngram_join._families):
        found = of(nodes, rules)
        groups.append({(r.node, r.family) for r in nodes.collect()})
        assert {r.key for r in found[0].collect()} == {family for _, family in groups[-1]}
        return found

    monkeypatch.setattr(S, "links", links)
    monkeypatch.setattr(S.ngram_join, "_families", families)
    plan = S.by_sets()
    assert sorted(r.doc_id for r in S.keep_one(docs, plan).collect()) == [0, 4, 8]
    assert linked == [(len({S.fingerprint(t, plan) for t in texts}), plan)] and (plan.words, plan.radius) == (1, 2)
    assert len(groups) == 1 and len({family for _, family in groups[0]}) < len(groups[0]) == 8


def test_keep_one_by_sets_removes_what_fingerprints_link(spark):
    """Texts of one much repeated passage: their fingerprints are near and their sets are not; both kinds of links chain."""
    passage, plan = "salt pepper sugar flour butter", S.by_sets()
    own = {side: " ".join(f"{side}{i}" for i in range(30)) for side in "abc"}
    texts = [f"{passage} " * 300 + own["a"], f"{passage} " * 300 + own["b"], f"{passage} " * 2 + own["b"], own["c"]]
    fps = [int.from_bytes(S.fingerprint(t, plan), "big") for t in texts]
    sets = [set(S.shingle_hashes(t, 5).tolist()) for t in texts]
    assert (fps[0] ^ fps[1]).bit_count() <= 2 < (fps[1] ^ fps[2]).bit_count()
    assert 100 * len(sets[0] & sets[1]) < 80 * len(sets[0] | sets[1]) and sets[1] == sets[2]
    odd = [None, " ", f"{passage} " * 300 + own["c"]]
    ids = [5, 4, 1, 2, 7, 6, 8]
    docs = spark.createDataFrame(list(zip(ids, texts + odd, strict=True)), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in S.keep_one(docs, plan).collect()) == [1, 2, 6]
