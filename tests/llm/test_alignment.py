import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from chatterloom.llm import alignment as A


@pytest.fixture(scope="module")
def pair():
    contents = [open(f"{A.FOLDER}/{name}", "rb").read() for name in (A.BYTE_BPE, A.PIECE_BPE)]
    return A.Pair(*contents)


def tokens(pair, text):
    """Ids and byte ranges of both sides, each text encoded whole and by itself."""
    if not text:
        return [], []
    ids = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    sides = []
    for one, table in zip(ids, (pair.a_bytes, pair.b_bytes), strict=True):
        at, side = 0, []
        for i in one:
            side.append((i, at, at + len(table[i])))
            at += len(table[i])
        sides.append(side)
    want = (" " + text).encode()
    if any(b"".join(t[i] for i, _, _ in s) != want for s, t in zip(sides, (pair.a_bytes, pair.b_bytes), strict=True)):
        return [], []
    return sides


def brute(pair, rows):
    """The contract's columns, from the byte ranges of all pairs of tokens."""
    documents, counts = [], Counter()
    for key, text in rows:
        a, b = tokens(pair, text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        lows = [0, *cuts[:-1]]
        groups = ["|".join(",".join(str(t[0]) for t in side if low < t[2] <= high) for side in (a, b)) for low, high in zip(lows, cuts, strict=False)]
        counts.update(set(links))
        documents.append((key, len(a), len(b), len(cuts), links, sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [(k, n_a, n_b, n_g, len(ls), sum(counts[x] == best[x[0]] for x in ls), sum(counts[x] for x in ls), h) for k, n_a, n_b, n_g, ls, h in documents]


TEXTS = [
    None, "", " ", "a", "  two  spaces ", "tab\tand\nline\r\n\n\n", "Été déjà vu, naïve façade — 漢字 😀🏽 \x00 end", "<|endoftext|> <s> </s> <unk> <0x41>",
    "▁ is a piece sign", "don't we'll THEY'RE 12345 3.14159 x_y-z", "ﬁ ½ ① Å   　 ​ zero", "word word word word", "word word word word",
    "supercalifragilisticexpialidocious antidisestablishmentarianism", "مرحبا بالعالم שלום नमस्ते", "퟿￿",
]


def test_query_equals_brute_force(spark, pair, documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (None, "no id")]
    rows += [(100 + r.doc_id, r.text) for r in documents.select("doc_id", "text").collect() if len(r.text) < 1500]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, id string, chunk string").repartition(3)
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for chunk_bytes in (1, 8 << 20):
        found = A.link_counts(docs, chunk_bytes=chunk_bytes).select(columns).collect()
        assert sorted(map(tuple, found), key=str) == sorted(brute(pair, rows), key=str)


def test_links_and_groups(spark, pair):
    rows = list(enumerate(TEXTS))
    for r in A.align(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        a, b = tokens(pair, TEXTS[r.id])
        assert (r.a_ids, r.b_ids) == ([x[0] for x in a], [y[0] for y in b])
        assert list(zip(r.link_a, r.link_b, strict=True)) == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        assert r.group_end == cuts
        assert [a[i - 1][2] for i in r.group_a] == cuts == [b[j - 1][2] for j in r.group_b]


def test_texts_that_are_not_given_back_have_no_tokens(spark, pair):
    assert tokens(pair, "▁ is a piece sign") == ([], [])
    found = A.link_counts(spark.createDataFrame([(1, "▁ is a piece sign")], "doc_id bigint, text string")).collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_parts_give_the_tokens_of_the_whole(pair, monkeypatch):
    rng = random.Random(2)
    words = "the of Quick brown's 12 don't 's 've — été 漢字 \n \t a I  x. (y) z! ' '' <|endoftext|> \xa0 1,000 -- ...".split(" ")
    monkeypatch.setattr(A, "_KNOWN", 20)
    for _ in range(300):
        text = " ".join(rng.choice(words) for _ in range(60))
        whole = tokens(pair, text)
        found = pair.encode([text, None, text])
        for side, bounds, want in zip(found[::2], found[1::2], whole, strict=True):
            ids = [x[0] for x in want]
            assert side.tolist() == ids + ids and bounds.tolist() == [0, len(ids), len(ids), 2 * len(ids)]


def test_no_token_holds_a_space_after_a_printing_character(pair):
    """What the cuts at such spaces rest on."""
    for table in (pair.a_bytes, pair.b_bytes):
        assert not [x for x in table if re.search(rb"[!-~] ", x)]


def test_lockstep_on_random_ends():
    rng = np.random.default_rng(4)
    for _ in range(50):
        total = int(rng.integers(1, 200))
        a, b = (np.union1d(rng.integers(1, total + 1, rng.integers(0, 60)), [total]) for _ in "ab")
        starts = [0, *(np.nonzero(np.isin(a[:-1], b))[0][::3] + 1)]
        i = np.array(starts)
        j = np.array([0, *np.searchsorted(b, a[i[1:] - 1]) + 1])
        links_i, links_j, cuts_i, cuts_j = A.lockstep(a, b, i, j, np.append(i[1:], len(a)))
        low_a, low_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if low_a[x] < b[y] and low_b[y] < a[x]}
        assert set(zip(links_i.tolist(), links_j.tolist(), strict=True)) == want and len(links_i) == len(want)
        assert sorted(a[cuts_i]) == sorted(b[cuts_j]) == sorted(set(a.tolist()) & set(b.tolist()))


def test_no_documents(spark, no_docs):
    assert A.link_counts(no_docs).collect() == [] and A.align(no_docs).collect() == []
