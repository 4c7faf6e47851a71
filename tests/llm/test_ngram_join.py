import random

import numpy as np
import pytest

from chatterloom.llm import ngram_join as J

SMALL_GROUPS = J.Rules(group_rows=4, group_tokens=200)


def shingles(text, size=4):
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def brute(rows, percent=85):
    """(id, size, smallest id reachable) of every row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    members = {}
    for i, (key, _) in enumerate(rows):
        members.setdefault(find(i), []).append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in members.items()}
    return sorted([(key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows)], key=str)


def found(spark, rows, rules=J.Rules()):
    docs = spark.createDataFrame([(*r, "x", "y", 1.5) for r in rows], "doc_id bigint, text string, id string, row string, tokens double")
    return sorted((tuple(r) for r in J.similar_groups(docs.repartition(3), rules).collect()), key=str)


def family(number, copies, words, edits, rng, alternatives=10**9):
    """Copies of one text with some words replaced, each by one of so many others."""
    text = [f"t{number}w{i}" for i in range(words)]
    out = []
    for copy in range(copies):
        own = list(text)
        for at in rng.sample(range(words), edits):
            own[at] = f"t{number}e{rng.randrange(alternatives)}"
        out.append(" ".join(own))
    return out


def corpus():
    rng = random.Random(8)
    texts = [None, "", "  \n", "one", "ONE", "one two", "one two three", "one two three", "a b c d", "a  B\tc\nd", "b c d a"]
    for number, (words, edits, alternatives) in enumerate([(60, 1, 10**9), (60, 2, 10**9), (60, 3, 4), (200, 4, 10**9), (200, 4, 3), (200, 8, 2), (30, 1, 2), (12, 1, 3)]):
        texts += family(number, 12, words, edits, rng, alternatives)
    chain = [f"c{i}" for i in range(160)]
    texts += [" ".join(chain[4 * i : 4 * i + 100]) for i in range(15)]  # each links with its neighbours only
    line = "every page of this site ends with the same long line of words that says nothing at all to anyone"
    texts += [f"{' '.join(rng.choice('uvwxyz') + str(rng.randrange(50)) for _ in range(rng.randrange(4, 60)))} {line}" for _ in range(60)]
    texts += [line, line + " x", line + " x y", "z " + line, line + " " + line]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, (3, "one"), (None, "one two"), (None, "nobody has this text at all"), (500, texts[30]), (500, texts[30])]


@pytest.mark.parametrize("rules", [J.Rules(), SMALL_GROUPS, J.Rules(group_rows=2, group_tokens=1)])
def test_equals_brute_force(spark, rules):
    rows = corpus()
    assert found(spark, rows, rules) == brute(rows)


@pytest.mark.parametrize("family", ["0", "id", "id % 5"])
def test_families_change_no_result(spark, family):
    """All in one, each in its own, or mixed: what they bring together is compared, the rest is met across groups."""
    rows = [(n, text) for n, (_, text) in enumerate(corpus())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    families = docs.selectExpr("doc_id as id").selectExpr("id", f"bigint({family}) as family")
    similar = J.similar_groups(docs, SMALL_GROUPS, families=families)
    assert sorted((tuple(r) for r in similar.collect()), key=str) == brute(rows)


def test_documents_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows) == found(spark, rows, SMALL_GROUPS)


def test_just_at_and_below_the_similarity(spark):
    def pair(number, same, own):
        words = [f"p{number}w{i}" for i in range(same + 3)]
        return [" ".join([*words, *(f"p{number}{side}{i}" for i in range(own))]) for side in "ab"]

    at = [t for i in range(20) for t in pair(i, 170, 15)]  # 170 / 200
    below = [t for i in range(20, 40) for t in pair(i, 169, 15)]
    ids = [c for _, _, c in sorted(found(spark, list(enumerate(at + below)), SMALL_GROUPS), key=lambda r: r[0])]
    assert ids == [i // 2 * 2 for i in range(40)] + list(range(40, 80))


def test_edges_and_empty(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in J.similar_groups(edge_docs).collect()), key=str) == brute(rows)
    assert J.similar_groups(no_docs).collect() == []


@pytest.mark.parametrize(("edits", "linked"), [(1, True), (4, True), (5, False), (7, False)])
def test_work_grows_with_a_family(spark, monkeypatch, edits, linked):
    """Similarities of about 0.95, 0.82, 0.78 and 0.70: the overlaps computed stay in proportion to the copies."""
    counts = []
    for copies in (150, 300):
        done = spark.sparkContext.accumulator(0)
        overlaps = J.overlaps

        def counted(left, right, union, done=done, overlaps=overlaps):
            done.add(len(left) * len(right))
            return overlaps(left, right, union)

        with monkeypatch.context() as patched:
            patched.setattr(J, "overlaps", counted)
            texts = family(0, copies, 400, edits, random.Random(edits))
            ids = {c for _, _, c in found(spark, list(enumerate(texts)), J.Rules(5, 80))}
        assert (len(ids) == 1) == linked
        counts.append(done.value)
    assert counts[1] > 0 or not linked
    assert counts[1] < 2.6 * counts[0] + 1000


def test_families_of_one_share_groups(spark, monkeypatch):
    """Near copies that no fingerprint brings together: their groups are few, as each pair of groups may be opened."""
    groups, made = [], J._candidates
    monkeypatch.setattr(J, "_candidates", lambda rows, rules: groups.append(rows.select("gid").distinct().count()) or made(rows, rules))
    texts = family(0, 150, 400, 4, random.Random(2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    similar = J.similar_groups(docs, J.Rules(5, 80), families=docs.selectExpr("doc_id as id", "doc_id as family"))
    assert {r.component_id for r in similar.collect()} == {0}
    assert groups[0] < 150 / 8


def test_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 20)) for _ in range(9)]
    union = np.unique(np.concatenate(sets[:6]))
    want = [[len(np.intersect1d(a, b)) for b in sets[:6]] for a in sets]
    assert J.overlaps(sets, sets[:6], union).tolist() == want
