import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chatterloom.llm import chunks, components, exact_dedup, line_dedup, suffix_dedup
from chatterloom.session import scratch_path

UP = {c: c + 32 for c in range(65, 91)}


def _bytes(text):
    return (text or "").encode()


# Exact


def _verdicts(spark, docs):
    rows = exact_dedup.digest_rows(docs)
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), 4)
    index.admit(rows)
    index.admit(rows)  # a repeated batch changes nothing
    found = exact_dedup.verdicts(rows, index).collect()
    index.close()
    return found


def test_exact_groups(spark, edge_docs, no_docs):
    found = _verdicts(spark, edge_docs)
    groups = defaultdict(list)
    for r in edge_docs.collect():
        groups[hashlib.sha256(_bytes((r.text or "").translate(UP))).hexdigest()].append(r.doc_id)
    assert len(found) == edge_docs.count()
    for r in found:
        ids = groups[r.text_sha256]
        assert r.id in ids and r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    for digest in groups:
        assert sum(r.kept for r in found if r.text_sha256 == digest) == 1
    assert _verdicts(spark, no_docs) == []


def test_index_persists_and_new_data_is_appended(spark, edge_docs):
    path = scratch_path(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    half = edge_docs.filter("doc_id <= 6")
    first = exact_dedup.deduplicate(half, index)
    assert first.columns == edge_docs.columns
    assert sorted(r.doc_id for r in first.collect()) == [-2, 4, 6]
    index.close()
    again = exact_dedup.DigestIndex(spark, path, 4)
    second = [r.text for r in exact_dedup.deduplicate(edge_docs, again).collect()]
    known = {(r.text or "").translate(UP) for r in half.collect()}
    assert sorted(second) == sorted({(r.text or "") for r in edge_docs.collect() if (r.text or "").translate(UP) not in known})
    assert again.table().count() == len(known) + len(second)
    again.close()


# Components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_stars_and_noise(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    rng.shuffle(edges)
    above = {}

    def root(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        above[b] = a
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert found == {n: root(n) for u, v in edges if u != v for n in (u, v)}


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


# Byte strings


def _brute_repeats(docs):
    """By definition: strings of 50 bytes that start in a document with a smaller id."""
    first = {}
    for doc_id, raw in docs:
        for k in range(len(raw) - 49):
            w = raw[k : k + 50]
            first[w] = min(first.get(w, doc_id), doc_id)
    for doc_id, raw in docs:
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < doc_id:
                gone[k : k + 50] = b"\1" * 50
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        yield doc_id, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def _planted(seed):
    """Texts over few letters that share pieces of many lengths, nested and with different neighbours."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcé \n") for _ in range(n))
    pool = [word(rng.choice([30, 49, 50, 51, 60, 76, 77, 120, 400])) for _ in range(12)]
    pool += [p[5:70] for p in pool[:5]] + ["in " * 60, "x" * 130]
    return [(i, "".join(rng.choice([word(rng.randrange(40)), rng.choice(pool)]) for _ in range(rng.randrange(1, 9)))) for i in range(70)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_definition(spark, seed):
    docs = _planted(seed)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = sorted(map(tuple, suffix_dedup.repeats_digest(frame).collect()))
    assert found == sorted(_brute_repeats([(i, t.encode()) for i, t in docs]))
    assert sum(r[2] for r in found) > 1000


def test_repeats_edges(spark, edge_docs, no_docs):
    found = sorted(map(tuple, suffix_dedup.repeats_digest(edge_docs).collect()), key=str)
    rows = [(chunks.NO_ID if r.doc_id is None else r.doc_id, _bytes(r.text)) for r in edge_docs.collect()]
    wanted = [(None if r[0] == chunks.NO_ID else r[0], *r[1:]) for r in _brute_repeats(rows)]
    assert found == sorted(wanted, key=str)
    texts = suffix_dedup.repeats_removed(edge_docs).collect()
    assert sorted(hashlib.sha256(r.text).hexdigest() for r in texts) == sorted(r[4] for r in found)
    for r in texts:
        assert all(s.end - s.begin >= 1 for s in r.spans)
    assert suffix_dedup.repeats_digest(no_docs).collect() == []


def test_repeat_groups_have_all_occurrences(spark):
    shared = "A passage that three documents share, long enough to be of interest here."
    rows = [(i, f"{before}{shared}{after}") for i, (before, after) in enumerate([("one ", " uno"), ("two ", " due"), ("three ", " tre")])]
    groups = suffix_dedup.repeat_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert groups
    by_group = defaultdict(set)
    for r in groups:
        by_group[r.bucket, r.group].add(r.id)
        assert r.length >= 50
    assert {frozenset(ids) for ids in by_group.values()} >= {frozenset({0, 1, 2})}


def test_long_text_in_pieces(monkeypatch):
    text = bytes(random.Random(5).choices(b"abcdef ", k=5000))
    whole = suffix_dedup.spans_of([text])
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    parts = suffix_dedup.spans_of([text, b"short"])
    covered = lambda s: sorted(x for a, n in zip(s.start.tolist(), s.count.tolist(), strict=True) for x in range(a, a + n))
    assert covered(parts) == covered(whole) == list(range(5000 - 49))
    assert len(parts.start) > len(whole.start)


def test_packed_arrays_return():
    import numpy as np

    a, b = np.arange(1000, dtype="<u8") * 12345, np.arange(1000, dtype="<u4")
    x, y = chunks.unpack(chunks.pack((a, 5), b), ("<u8", 5), "<u4")
    assert (x == a).all() and (y == b).all()
    assert len(chunks.unpack(chunks.pack(a[:0]), "<u8")[0]) == 0


# Lines, paragraphs, sentences


def _brute_units(rows, unit, least):
    """Rows in rank order: (id, text)."""
    seen, result = set(), []
    for doc_id, text in rows:
        units = line_dedup.units_of(text, unit)
        flags = [u[2] in seen or any(u[2] == v[2] for v in units[:k]) for k, u in enumerate(units)]
        seen.update(u[2] for u in units)
        k = 0
        while k < len(units):
            end = k
            while end < len(units) and flags[end]:
                end += 1
            if end > k and sum(u[2].count(" ") + 1 for u in units[k:end]) < least:
                flags[k:end] = [False] * (end - k)
            k = max(end, k + 1)
        starts = [u[0] for u in units] + [len(text)]
        kept = text[: starts[0]] + "".join(text[starts[k] : starts[k + 1]] for k in range(len(units)) if not flags[k])
        result.append((doc_id, kept, len(units), sum(flags)))
    return result


@pytest.mark.parametrize(("unit", "least"), [("line", 1), ("paragraph", 1), ("sentence", 5)])
def test_units_equal_brute_force(spark, documents, unit, least):
    found = line_dedup.deduplicate_units(documents, unit=unit, least_words=least).collect()
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    assert sorted((r.id, r.text, r.n_units, r.n_removed) for r in found) == sorted(_brute_units(rows, unit, least))
    original = dict(rows)
    for r in found:
        raw, kept, at = original[r.id].encode(), b"", 0
        for s in r.removed:
            kept, at = kept + raw[at : s.begin], s.end
        assert (kept + raw[at:]).decode() == r.text


def test_units_cut_as_documented():
    texts = lambda s, unit: [u[2] for u in line_dedup.units_of(s, unit)]
    text = "  One two. Three!\nfour 5.5 five\n\n \nLast  ONE "
    assert texts(text, "line") == ["one two. three!", "four 5.5 five", "last one"]
    assert texts(text, "sentence") == ["one two.", "three!", "four 5.5 five", "last one"]
    assert texts(text, "paragraph") == ["one two. three! four 5.5 five", "last one"]
    assert [texts(" \n ", u) for u in line_dedup.UNITS] == [[], [], []]


def test_unit_edges(spark, edge_docs, no_docs):
    found = line_dedup.deduplicate_units(edge_docs).collect()
    assert len(found) == edge_docs.count()
    by_id = defaultdict(list)
    for r in found:
        by_id[r.id].append(r)
    assert sorted(r.text for r in by_id[3]) == ["", edge_docs.filter("doc_id = 3").first().text]  # one of two equal rows keeps it
    assert [r.text for r in by_id[7]] == [""] and [r.text for r in by_id[4]] == [""]
    assert [r.text for r in by_id[5]] == [""] and [r.n_units for r in by_id[9]] == [0]
    assert line_dedup.deduplicate_units(no_docs).collect() == []
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("The same line of all.\nOwn line "), "id").alias("text"))
    found = line_dedup.deduplicate_units(hot.repartition(6)).collect()
    assert sum(r.n_removed for r in found) == 2999 and min(r.id for r in found if not r.n_removed) == 0
