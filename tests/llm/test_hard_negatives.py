import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterloom.llm import hard_negatives as H
from chatterloom.llm.queries import QUERIES

COLUMNS = ["anchor_id", "positive_id", "place", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, rules, is_anchor, relabel):
    """Rows of (id, vector, label) as the docstring says, with Python integers."""
    kept = []
    for number, (key, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if key is not None:
            label = relabel(key, label)
        kept.append((number, key, [int(np.floor(rules.scale * float(np.float32(x)))) for x in vector], label))
    order = lambda scored: sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))
    out = []
    for number, key, vector, label in kept:
        if key is None or not is_anchor(key):
            continue
        scored = [(sum(a * b for a, b in zip(vector, v, strict=False)), k, n, lab) for n, k, v, lab in kept]
        positives = order(s for s in scored if s[3] == label and s[2] != number)[: rules.positives]
        for place, (best, positive, _, _) in enumerate(positives, 1):
            fit = order(s for s in scored if s[3] != label and rules.low * best <= 100 * s[0] <= 100 * best)
            out += [(key, positive, place, rank, s[1], best, s[0]) for rank, s in enumerate(fit[: rules.negatives], 1)]
    return out


def found(spark, rows, rules, anchor, relabel, tmp):
    rows = [(k, v and [x if x is None else float(x) for x in v], label) for k, v, label in rows]
    shuffled = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1)
    shuffled.selectExpr("*", "'x' AS q", "'y' AS row", "'z' AS id", "'b' AS block").write.mode("overwrite").parquet(tmp)
    result = H.hard_negatives(spark.read.parquet(tmp), anchor, rules, relabel=relabel)
    return sorted((tuple(r) for r in result.select(COLUMNS).collect()), key=str)


def test_packed_scores_are_exact():
    rng = np.random.default_rng(5)
    for top in (1, 300, 2**18, 2**24, 2**40, 2**70):
        a, r = (np.floor(rng.uniform(-top, top, (n, 9))) for n in (5, 23))
        want = [[sum(int(x) * int(y) for x, y in zip(v, w, strict=True)) for w in r] for v in a]
        assert H.packed_scores(a, r).tolist() == want
    assert H.packed_scores(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0] * 3] * 2
    assert H.packed_scores(np.zeros((0, 4)), np.ones((3, 4))).shape == (0, 3)


def test_several_rows_share_a_wide_integer():
    bits = (64 * 512 * 512).bit_length()
    assert H._DOUBLE_BITS // bits == 2


def rows_with_edges():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)], rng.choice([0, 1, 2, 9])) for i in range(300)]
    rows += [(i, [0.5, -0.25, 0.125, 0, 0, 0], 1) for i in range(300, 320)]  # ties
    rows += [(i, [0.5, -0.25, 0.125, 0, 0, 0], 2) for i in range(320, 340)]
    rows += [(100, [0.1] * 6, 1), (100, [0.1] * 6, 1), (105, None, 1), (110, [0.1] * 6, None)]  # repeated, nulls
    rows += [(400, [0.1, None, 0, 0, 0, 0], 1), (500, [float("nan")] * 6, 1), (600, [float("inf")] * 6, 2)]
    rows += [(None, [0.4, -0.2, 0.1, 0, 0, 0], 1), (None, [0.4, -0.2, 0.1, 0, 0, 0], 2)]
    rows += [(700, [], 1), (701, [0.2, 0.1], 2), (702, [0.3] * 9, 1), (710, [50_000.0, 1, 1, 1, 1, 1], 2), (711, [40_000.0, 1, 1, 1, 1, 1], 2)]
    return rows


@pytest.mark.parametrize("rules", [H.Rules(), H.Rules(anchor_rows=7, block_rows=20), H.Rules(2, 9, 50, 16, 5, 50)])
def test_equals_brute_force(spark, tmp_path, rules):
    rows = rows_with_edges()
    want = brute(rows, rules, lambda k: k % 10 == 0, lambda k, label: (label + 1) % 10 if k % 7 == 0 else label)
    relabel = lambda k, label: F.when(k % 7 == 0, (label + 1) % 10)
    assert found(spark, rows, rules, lambda k: k % 10 == 0, relabel, str(tmp_path / "v")) == sorted(want, key=str)
    assert len(want) > 200


def test_no_rows(spark, tmp_path):
    assert found(spark, [], H.Rules(), lambda k: k % 10 == 0, lambda _, label: label, str(tmp_path / "v")) == []
    assert found(spark, [(1, [0.5], 1), (2, [0.5], 1)], H.Rules(), lambda k: k == 5, lambda _, label: label, str(tmp_path / "w")) == []
    assert found(spark, [(1, [0.5], 1), (2, [0.5], 1)], H.Rules(), lambda k: k == 1, lambda _, label: label, str(tmp_path / "x")) == []


def test_scores_beyond_long_raise(spark, tmp_path):
    rows = [(1, [3e38], 1), (2, [3e38], 1)]
    with pytest.raises(Exception, match="(?i)overflow|too (big|large)"):
        found(spark, rows, H.Rules(), lambda k: k == 1, lambda _, label: label, str(tmp_path / "v"))


def test_query_has_five_negatives_at_most(spark):
    rows = QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001")
    assert rows.groupBy("anchor_id", "positive_id").agg(F.max("rank").alias("n")).filter("n > 5").isEmpty()
