import random
import re

import pytest

from chatterloom.llm import contamination as C

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def tokens(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    windows = {}
    for item, text in items:
        its = tokens(text)
        n = min(13, len(its))
        for k in range(len(its) - n + 1 if its else 0):
            windows.setdefault(tuple(its[k : k + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    for doc_id, text in docs:
        own, found = tokens(text), set()
        hit = [False] * len(own)
        for n in lengths:
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in windows:
                    found |= windows[tuple(own[k : k + n])]
                    hit[k : k + n] = [True] * n
        n_hit = sum(hit)
        yield doc_id, len(own), n_hit, sorted(found), n_hit > 0 and 20 * n_hit >= len(own)


def judged(docs, benchmark, **options):
    found = C.judge(docs, benchmark, keep=["doc_id"], **options).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found), key=str)


def wanted(docs, benchmark):
    rows = ((r.doc_id, r.text) for r in docs.collect())
    return sorted(brute(rows, [(r.item_id, r.text) for r in benchmark.collect()]), key=str)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 1}, {"block_words": 200}])
def test_documents_equal_brute_force(documents, benchmark, options):
    assert judged(documents, benchmark, **options) == wanted(documents, benchmark)


def planted(spark, seed):
    """Few distinct words, short and overlapping items, repeated ones, items inside others."""
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choice("a b c D É 漢 7 e-f".split()) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(25)]
    items += [(90, items[3][1]), (91, None), (92, "-- !"), (93, items[6][1] + " " + items[7][1])]
    pieces = [t for _, t in items if t]
    docs = [(i, " ".join(rng.choice([some(4), "zz zz", rng.choice(pieces).upper()]) for _ in range(rng.randrange(12)))) for i in range(60)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"shard_bytes": 50}), (3, {"block_words": 40})])
def test_planted_items_equal_brute_force(spark, seed, options):
    docs, items = planted(spark, seed)
    assert judged(docs, items, **options) == wanted(docs, items)


def test_longest_match_and_places(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"x y {passage} z"), (2, " ".join(passage.split()[5:25]) + " p99"), (3, "x y z")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in C.judge(docs, spark.createDataFrame([(7, passage)], "item_id bigint, text string")).collect()}
    assert [(found[d].longest_match, [tuple(m) for m in found[d].matches]) for d in (1, 2, 3)] == [
        (40, [("7", 0, 2, 40)]), (20, [("7", 5, 0, 20)]), (0, []),
    ]


def test_edges(spark, edge_docs, no_docs, benchmark):
    assert judged(edge_docs, benchmark) == wanted(edge_docs, benchmark)
    items = edge_docs.selectExpr("doc_id as item_id", "text").filter("item_id in (7, 10)")
    assert judged(edge_docs, items) == wanted(edge_docs, items)
    empty = benchmark.limit(0)
    assert all(not r[4] and r[2] == 0 for r in judged(edge_docs, empty))
    assert judged(no_docs, benchmark) == []
    kept = C.decontaminate(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in edge_docs.collect() if (r.doc_id, r.text) in {(d, t) for d, t in ((x.doc_id, x.text) for x in edge_docs.collect()) if not next(brute([(d, t)], [(i.item_id, i.text) for i in items.collect()]))[4]})
