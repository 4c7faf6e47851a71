"""Hard negatives: close rows of another label for each anchor and positive, by exact integer scores.

Components become integers, a row's score is its inner product with the anchor. Scores come from Kronecker-packed
products: the components of several candidates, made non-negative by a bias, lie in separate fields of one wide integer;
one product per component of the anchor, summed, holds the scores of all of them, and the fields are wide enough that
no sum reaches its neighbour. What the biases added is taken off again, so scores are exact. A wide integer is a double
as long as it stays below 2**53 (a matrix product then does the sums, without rounding), else a Python integer.

Anchors and rows are dealt into blocks of bounded size by a hash; a task takes one block of each. The first pass finds
each anchor's positives, the second, which knows their scores, the negatives below them. A pair of blocks returns the
first few rows of each anchor (or anchor and positive), and a rank over these gives the result.

Rows with a null label, a null vector, or a null or non-finite component take no part. Order is by score, larger first,
then by id (null last), then by row: repeated rows are rows of their own. A row with a null id keeps its label and is
no anchor. Vectors of different lengths are filled up with zeros. No rows give no rows. Extra columns are ignored.
A score beyond 64 bits raises ``OverflowError``, as it has no long value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterloom.llm.common import map_arrow, store

#: Exact integers in a double; the fields of a Python integer.
_DOUBLE_BITS, _WIDE_FIELDS = 53, 8
#: Rows with a larger component are dealt into blocks of their own, so that they don't slow down others.
_LARGE = float(1 << 18)
_NONE = np.iinfo(np.int64).min
_SLICE = 128  # anchors scored at a time


@dataclass(frozen=True)
class Rules:
    """``positives`` per anchor, ``negatives`` per positive, with low * positive <= 100 * negative <= 100 * positive."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    scale: int = 256
    anchor_rows: int = 4096
    block_rows: int = 8192


# Packed products


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products (anchors x rows) of whole numbers given as doubles; int64, or Python integers if large."""
    if not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    dims = rows.shape[1]
    low_a, low_r = int(min(anchors.min(initial=0), 0)), int(min(rows.min(initial=0), 0))
    top_a, top_r = int(anchors.max(initial=0)) - low_a, int(rows.max(initial=0)) - low_r
    bits = max((dims * top_a * top_r).bit_length(), 1)
    wide = bits > _DOUBLE_BITS
    fields = _WIDE_FIELDS if wide else _DOUBLE_BITS // bits
    if wide:
        anchors, rows = (np.frompyfunc(int, 1, 1)(x) for x in (anchors, rows))
    a, r = anchors - low_a, rows - low_r
    groups = -(-len(r) // fields)
    r = np.concatenate([r, np.zeros((groups * fields - len(r), dims), r.dtype)]).reshape(groups, fields, dims)
    words = r[:, 0]
    for field in range(1, fields):
        words = words + r[:, field] * (1 << field * bits if wide else float(1 << field * bits))
    products = a @ words.T  # one product per component of an anchor serves all fields
    if not wide:
        products = products.astype(np.int64)
    out = np.empty((len(a), groups, fields), products.dtype)
    for field in range(fields):
        out[:, :, field] = (products >> field * bits) & ((1 << bits) - 1)
    scores = out.reshape(len(a), -1)[:, : len(rows)]
    # (a - la)(r - lr) summed, less what the biases added
    sums_a, sums_r = anchors.sum(axis=1), rows.sum(axis=1)
    if not wide:
        sums_a, sums_r = sums_a.astype(np.int64), sums_r.astype(np.int64)
    return scores + low_r * sums_a[:, None] + low_a * sums_r[None] - dims * low_a * low_r


def first_rows(scores: np.ndarray, allowed: np.ndarray, count: int) -> list[np.ndarray]:
    """For each line of ``scores``, the places of its ``count`` largest allowed values, ties in the order of places."""
    if scores.dtype == object:
        picked = [np.nonzero(line)[0] for line in allowed]
        return [np.array(sorted(p, key=lambda at, s=s: (-s[at], at))[:count], int) for p, s in zip(picked, scores, strict=True)]
    held = np.where(allowed, scores, _NONE)
    least = np.full(len(held), _NONE)
    if held.shape[1] > count:
        least = np.partition(held, held.shape[1] - count, axis=1)[:, -count]
    lines, places = np.nonzero((held >= least[:, None]) & allowed)
    order = np.lexsort((places, -held[lines, places], lines))
    cuts = np.searchsorted(lines[order], np.arange(len(held) + 1))
    return [places[order[a:b]][:count] for a, b in zip(cuts, cuts[1:], strict=False)]


# Blocks


def clean_rows(vectors: DataFrame, rules: Rules, id_col: str, vector_col: str, label_col: str, relabel: Callable[[Column, Column], Column]) -> DataFrame:
    """``row``, ``id``, ``label``, ``q`` (whole numbers as doubles), ``large`` of the rows that take part, stored."""
    narrow = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("q")
    )
    bad = F.exists("q", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    fit = narrow.filter(F.col("label").isNotNull() & F.col("q").isNotNull()).filter(~bad)
    label = F.coalesce(relabel(F.col("id"), F.col("label")), F.col("label"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("q")
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * rules.scale)
            lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            large = np.zeros(len(lengths), bool)
            large[np.searchsorted(ends, np.nonzero(np.abs(values) > _LARGE)[0], side="right")] = True
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            arrays = [*(batch.column(c) for c in ("row", "id", "label")), pa.ListArray.from_arrays(offsets, values), pa.array(large)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "label", "q", "large"])

    numbered = fit.select(F.monotonically_increasing_id().alias("row"), "id", label.alias("label"), "q")
    return store(map_arrow(numbered, whole, "row bigint, id bigint, label bigint, q array<double>, large boolean"), "vectors")


def _dealt(rows: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """Rows with their ``block``, and the number of blocks; large rows have the blocks after the others'."""
    counts = {r["large"]: r["n"] for r in rows.groupBy("large").agg(F.count(F.lit(1)).alias("n")).collect()}
    usual, large = (-(-counts.get(kind, 0) // block_rows) for kind in (False, True))
    spread = F.xxhash64("row")
    block = F.when(F.col("large"), usual + F.pmod(spread, F.lit(max(large, 1)))).otherwise(F.pmod(spread, F.lit(max(usual, 1))))
    return rows.withColumn("block", block.cast("int")), usual + large


def _blocks(rows: DataFrame, *extra: str) -> DataFrame:
    """One line per block: its rows in the order of ids."""
    member = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "label", "q", *extra)
    return rows.groupBy("block").agg(F.array_sort(F.collect_list(member)).alias("rows"))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows x components, shorter rows filled up with zeros."""
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    grid = np.zeros((len(lengths), int(lengths.max(initial=0))))
    grid[np.arange(grid.shape[1])[None] < lengths[:, None]] = values
    return grid


def _paired(anchors: DataFrame, rows: DataFrame, n_anchor_blocks: int, work: Callable, schema: str) -> DataFrame:
    """``work(anchors, rows)`` on every block of anchors with every block of rows, stored."""
    each = rows.withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(max(n_anchor_blocks - 1, 0)))))
    sides = anchors.select(F.col("block").alias("anchor_block"), F.col("rows").alias("anchors"))
    pairs = each.join(sides.hint("merge"), "anchor_block").select("anchors", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from work(*(batch.column(name)[at : at + 1].flatten() for name in ("anchors", "rows")))

    return store(map_arrow(pairs, run, schema), "scored")


def _slices(anchors: pa.StructArray, rows: pa.StructArray) -> Iterator[tuple[int, int, np.ndarray]]:
    a, r = _matrix(anchors.field("q")), _matrix(rows.field("q"))
    dims = max(a.shape[1], r.shape[1])
    a, r = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (a, r))
    for low in range(0, len(a), _SLICE):
        yield low, min(low + _SLICE, len(a)), packed_scores(a[low : low + _SLICE], r)


def _longs(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.int64())


def _result(columns: dict[str, list], ids: pa.Array, rows: np.ndarray, places: list[int]) -> pa.RecordBatch:
    own = np.array(places, np.int64)
    arrays = {**columns, "id": ids.take(pa.array(own)), "row": pa.array(rows[own], pa.int64())}
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else _longs(x) for x in arrays.values()], names=list(arrays))


def _positives(anchors: DataFrame, rows: DataFrame, n_anchor_blocks: int, rules: Rules) -> DataFrame:
    """``anchor_row``, ``place`` (from 1), ``positive_row``, ``positive_id``, ``positive_score``."""

    def work(anchors: pa.StructArray, rows: pa.StructArray) -> Iterator[pa.RecordBatch]:
        labels, own = rows.field("label").to_numpy(), rows.field("row").to_numpy()
        anchor_labels, anchor_rows = anchors.field("label").to_numpy(), anchors.field("row").to_numpy()
        for low, high, scores in _slices(anchors, rows):
            allowed = (anchor_labels[low:high, None] == labels) & (anchor_rows[low:high, None] != own)
            found = first_rows(scores, allowed, rules.positives)
            lines = [line for line, places in enumerate(found) for _ in places]
            places = [int(p) for one in found for p in one]
            columns = {"anchor_row": anchor_rows[low:high][lines], "score": [scores[x, p] for x, p in zip(lines, places, strict=True)]}
            yield _result(columns, rows.field("id"), own, places)

    near = _paired(_blocks(anchors), _blocks(rows), n_anchor_blocks, work, "anchor_row bigint, score bigint, id bigint, row bigint")
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rules.positives)
    return ranked.select("anchor_row", "place", F.col("row").alias("positive_row"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))


def _negatives(anchors: DataFrame, rows: DataFrame, n_anchor_blocks: int, rules: Rules) -> DataFrame:
    """``anchor_row``, ``place``, ``rank``, ``negative_row``, ``negative_id``, ``negative_score``; anchors have ``tops``."""

    def work(anchors: pa.StructArray, rows: pa.StructArray) -> Iterator[pa.RecordBatch]:
        labels, own = rows.field("label").to_numpy(), rows.field("row").to_numpy()
        anchor_labels, anchor_rows = anchors.field("label").to_numpy(), anchors.field("row").to_numpy()
        tops = anchors.field("tops").to_pylist()
        for low, high, scores in _slices(anchors, rows):
            other = anchor_labels[low:high, None] != labels
            for place in range(1, rules.positives + 1):
                lines = np.array([x for x in range(high - low) if len(tops[low + x]) >= place], int)
                if not len(lines):
                    break
                most = np.array([tops[low + x][place - 1] for x in lines], scores.dtype)[:, None]
                mine = scores[lines]
                if mine.dtype != object and int(np.abs(mine).max(initial=0)) >= 2**55:
                    mine, most = mine.astype(object), most.astype(object)
                allowed = other[lines] & (mine <= most) & (100 * mine >= rules.low * most)
                found = first_rows(mine, allowed.astype(bool), rules.negatives)
                at = [line for line, places in enumerate(found) for _ in places]
                places = [int(p) for one in found for p in one]
                columns = {
                    "anchor_row": anchor_rows[low:high][lines[at]], "place": [place] * len(at),
                    "score": [mine[x, p] for x, p in zip(at, places, strict=True)],
                }
                yield _result(columns, rows.field("id"), own, places)

    near = _paired(_blocks(anchors, "tops"), _blocks(rows), n_anchor_blocks, work, "anchor_row bigint, place bigint, score bigint, id bigint, row bigint")
    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rules.negatives)
    return ranked.select(
        "anchor_row", F.col("place").cast("int").alias("place"), F.col("rank").cast("int").alias("rank"),
        F.col("row").alias("negative_row"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    )


def hard_negatives(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], rules: Rules = Rules(), *,
    relabel: Callable[[Column, Column], Column] = lambda _, label: label,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``place`` of the positive, ``rank``, ``negative_id`` and both scores.

    ``is_anchor`` chooses anchors by id; ``relabel(id, label)`` gives the label that counts (null: unchanged).
    """
    rows = clean_rows(vectors, rules, id_col, vector_col, label_col, relabel)
    dealt, _ = _dealt(rows, rules.block_rows)
    chosen = rows.filter(F.coalesce(is_anchor(F.col("id")), F.lit(False)))
    anchors, n_blocks = _dealt(chosen, rules.anchor_rows)
    positives = store(_positives(anchors, dealt, n_blocks, rules), "positives")
    # at most ``rules.positives`` scores of an anchor, largest first
    tops = positives.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("tops"))
    wanted = anchors.join(store(tops, "tops").hint("merge"), "row")
    negatives = store(_negatives(wanted, dealt, n_blocks, rules), "negatives")
    named = positives.join(chosen.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")).hint("merge"), "anchor_row")
    return named.join(negatives.hint("merge"), ["anchor_row", "place"]).select(
        "anchor_id", "positive_id", "place", "rank", "negative_id", "positive_score", "negative_score"
    )
