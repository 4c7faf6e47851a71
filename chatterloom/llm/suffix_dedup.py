"""Repeated byte strings across documents, by enhanced suffix arrays.

The suffixes of the whole corpus are dealt so that suffixes with a common prefix of ``LEAST`` bytes meet in one bucket:
each string of ``LEAST`` bytes has one anchor, the leftmost of its ``ANCHOR``-byte substrings with the smallest hash,
and goes where the anchor's hash says. Neighbouring strings mostly share their anchor; a span is such a run of strings,
and equal spans are one leaf of the suffix tree with several occurrences.

1. Each chunk sends the hashes of its anchors and spans; of equal spans only those of its smallest id.
2. Each bucket drops anchors that occur once. A span that a document with a smaller id has as well is removed. Where
   different spans share an anchor, their texts are asked for.
3. Each bucket sorts the suffixes of these texts, takes the longest common prefixes of neighbours and scans them with a
   stack: an interval of common prefixes is a group of all occurrences of a repeat. It is a maximal repeat if the bytes
   to the left differ (or lie outside the span); the others are parts of a longer one and are left out.
4. Each chunk marks what its spans lost and returns the rest.

A byte is removed if a string of ``LEAST`` bytes around it also starts in a document with a smaller id. Strings are
judged on the input and never cross documents. Null texts are empty; a null id is larger than any other; rows with equal
ids remove nothing from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.llm.chunks import (
    BLOBS, NO_ID, Chunk, ChunkStore, blob_rows, bucket_count, by_key, each_chunk, pack, split_by, store_chunks, unpack, with_replies,
)
from chatterloom.llm.common import store

LEAST, ANCHOR = 50, 24
_PER = LEAST - ANCHOR + 1  # anchors that a string can have, so a span has so many strings at most
_WIDEST = LEAST + _PER - 1
_PLACE = 28  # bits of the position in the sliding minimum; pieces of texts stay below
_PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ODD), -1, 2**64))
_BYTES = np.random.default_rng(977).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
ASHES, SASHES = ("<u8", 5), ("<u8", 6)  # bytes kept of an anchor's hash (besides its bucket) and of a span's


@dataclass
class Spans:
    """Runs of strings with one anchor: text, first string, number of strings, hash of the anchor and of the span."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    whole: np.ndarray


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _rolling(x: np.ndarray) -> np.ndarray:
    """Hashes of all ANCHOR-byte strings of the mapped bytes ``x``, by doubling: 8, 16, then 16 + 8 bytes."""
    h, width = x, 1
    while width < 8:
        h = h[:-width] * (_ODD + np.uint64(2 * width)) + h[width:]
        width *= 2
    wide = h[:-8] * (_ODD + np.uint64(16)) + h[8:]
    return _mix(wide[:-8] * (_ODD + np.uint64(32)) + h[16:])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width``."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in groups of about ``_PIECE`` bytes; a longer text in pieces that overlap by less than a string."""
    group, size = [], 0
    for doc, text in enumerate(texts):
        for base in range(0, max(len(text) - LEAST + 1, 0), _PIECE):
            piece = text[base : base + _PIECE + LEAST - 1]
            group.append((doc, base, piece))
            size += len(piece)
            if size >= _PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def spans_of(texts: list[bytes]) -> Spans:
    """All spans of all texts, in order: a function of the texts alone."""
    found = [_spans_of_group(group) for group in _pieces(texts)]
    if not found:
        return Spans(*(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64)))
    return Spans(*(np.concatenate(parts) for parts in zip(*found, strict=True)))


def _spans_of_group(group: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(b"".join(piece for _, _, piece in group), np.uint8)
    lengths = np.array([len(piece) for _, _, piece in group])
    first = np.concatenate(([0], np.cumsum(lengths)))
    x = _BYTES[raw]
    hashes = _rolling(x)
    places = np.arange(len(hashes), dtype=np.uint64)
    keys = (hashes & ~np.uint64(2**_PLACE - 1)) | places
    anchor = (_least(keys, _PER) & np.uint64(2**_PLACE - 1)).astype(np.int64)  # of the string that starts here
    inside = np.zeros(len(anchor) + LEAST, np.bool_)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        inside[low : high - LEAST + 1] = True
    at = np.nonzero(inside[: len(anchor)])[0]
    mine = anchor[at]
    fresh = np.ones(len(at), np.bool_)
    fresh[1:] = (np.diff(mine) != 0) | (np.diff(at) != 1)
    piece_of = np.searchsorted(first, at[fresh], "right") - 1
    begin = np.nonzero(fresh)[0]
    # Neighbouring pieces can share an anchor only at a border, where a text ends.
    count = np.diff(np.append(begin, len(at)))
    start = at[begin]
    # Sums of byte x power; a span's sum times the inverse power of its start does not depend on the place.
    power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(raw), _ODD))))
    sums = np.concatenate(([np.uint64(0)], np.add.accumulate(x * power[:-1])))
    inverse = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(raw), _BACK))))
    whole = (sums[start + count - 1 + LEAST] - sums[start]) * inverse[start]
    whole = _mix(whole ^ (count.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    docs = np.array([doc for doc, _, _ in group])[piece_of]
    bases = np.array([base for _, base, _ in group])[piece_of]
    return docs, start - first[piece_of] + bases, count, hashes[mine[begin]], whole


def _leaders(spans: Spans, ids: np.ndarray) -> np.ndarray:
    """Spans that no smaller id of the same chunk has: the others are removed without asking."""
    if not len(spans.doc):
        return np.empty(0, np.bool_)
    mine = ids[spans.doc]
    order = np.lexsort((mine, spans.whole, spans.anchor))
    fresh = np.ones(len(order), np.bool_)
    fresh[1:] = (np.diff(spans.anchor[order]) != 0) | (np.diff(spans.whole[order]) != 0)
    leads = np.empty(len(order), np.bool_)
    ranked = mine[order]
    leads[order] = ranked == ranked[fresh][np.cumsum(fresh) - 1]
    return leads


# Steps


def _send(chunk: Chunk, buckets: int) -> Iterator[pa.RecordBatch]:
    spans = spans_of(chunk.texts)
    number = np.nonzero(_leaders(spans, chunk.ids))[0]
    bucket = (spans.anchor[number] % np.uint64(buckets)).astype(np.int64)
    order, known, cuts = split_by(bucket)
    rows = []
    for b, low, high in zip(known.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        one = number[order[low:high]]
        step = np.diff(one, prepend=0).astype("<u4")
        data = pack((spans.anchor[one] // np.uint64(buckets), ASHES[1]), (spans.whole[one], SASHES[1]), chunk.ids[spans.doc[one]], step)
        rows.append((b, chunk.number, data))
    yield blob_rows(rows)


def _gather(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Anchor, span, id, chunk and number of everything sent to a bucket."""
    parts = []
    for chunk, data in zip(rows.column("chunk").to_pylist(), rows.column("data").to_pylist(), strict=True):
        anchor, whole, ids, step = unpack(data, ASHES, SASHES, "<i8", "<u4")
        parts.append((anchor, whole, ids, np.full(len(ids), chunk), np.cumsum(step.astype(np.int64))))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _replies(kind: int, chunk: np.ndarray, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Rows of ``bucket`` (here the kind of message), chunk and packed columns."""
    order, known, cuts = split_by(chunk)
    return [
        (kind, c, pack(*(column[order[low:high]] for column in columns)))
        for c, low, high in zip(known.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
    ]


def _first_of(*keys: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(keys[0]), np.bool_)
    fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return fresh


_REMOVED, _ASKED = 0, 1


def _compare(bucket: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Says which spans are in a smaller document too, and asks for the texts of different spans with one anchor."""
    anchor, whole, ids, chunk, number = _gather(rows)
    order = np.lexsort((ids, whole, anchor))
    anchor, whole, ids, chunk, number = (a[order] for a in (anchor, whole, ids, chunk, number))
    new_anchor, new_span = _first_of(anchor), _first_of(anchor, whole)
    least = ids[new_span][np.cumsum(new_span) - 1]
    removed = ids > least
    group = np.cumsum(new_anchor) - 1
    kinds = np.bincount(group, new_span)[group]
    ids_of = np.bincount(group, _first_of(anchor, ids))[group]
    asked = ~removed & (kinds > 1) & (ids_of > 1)
    full = np.full(removed.sum(), 2**32 - 1, "<u4")
    out = _replies(_REMOVED, chunk[removed], number[removed].astype("<u4"), full)
    out += _replies(_ASKED, chunk[asked], number[asked].astype("<u4"))
    yield blob_rows(out)


def _answer(chunk: Chunk, asked: list[bytes], buckets: int) -> Iterator[pa.RecordBatch]:
    """The texts of the spans that were asked for, to the buckets of their anchors."""
    spans = spans_of(chunk.texts)
    number = np.sort(np.concatenate([unpack(data, "<u4")[0] for data in asked])).astype(np.int64)
    order, known, cuts = split_by((spans.anchor[number] % np.uint64(buckets)).astype(np.int64))
    rows = []
    for b, low, high in zip(known.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        one = number[order[low:high]]
        starts, counts = spans.start[one], spans.count[one]
        pieces = [chunk.texts[d][s : s + c - 1 + LEAST] for d, s, c in zip(spans.doc[one].tolist(), starts.tolist(), counts.tolist(), strict=True)]
        head = pack(chunk.ids[spans.doc[one]], np.diff(one, prepend=0).astype("<u4"), counts.astype("<u1"))
        rows.append((b, chunk.number, len(head).to_bytes(8, "little") + head + b"".join(pieces)))
    yield blob_rows(rows)


def suffixes(texts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The enhanced suffix array of spans (rows padded with zeros): span, offset, common prefix with the one before, byte to the left.

    Suffixes of LEAST bytes and more; -1 is the byte to the left of a span.
    """
    span = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(span)) - np.repeat(np.cumsum(counts) - counts, counts)
    grid = np.zeros((len(texts), 2 * _WIDEST), np.uint8)
    grid[:, :_WIDEST] = texts
    rows = np.lib.stride_tricks.sliding_window_view(grid, _WIDEST, axis=1)[span, offset]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{_WIDEST}").reshape(-1), kind="stable")
    rows, span, offset = rows[order], span[order], offset[order]
    left = np.where(offset > 0, grid[span, np.maximum(offset - 1, 0)].astype(np.int16), -1)
    room = counts[span] - offset + LEAST - 1
    prefix = np.zeros(len(span), np.int64)
    differs = rows[1:] != rows[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), _WIDEST)
    prefix[1:] = np.minimum(common, np.minimum(room[1:], room[:-1]))
    return span, offset, prefix, left


def intervals(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals (first, last, length) of the suffix array with a common prefix of LEAST or more bytes.

    The interval tree is scanned with a stack; runs in which all common prefixes are equal are one interval each.
    """
    long_ = np.append(prefix >= LEAST, False)
    begin = np.nonzero(long_[1:] & ~long_[:-1])[0]  # the suffix before the first long prefix
    end = np.nonzero(~long_[1:] & long_[:-1])[0]
    if len(begin) > len(end):
        end = np.append(end, len(prefix) - 1)
    if not len(begin):
        return begin, end, begin
    bounds = np.stack([begin + 1, end + 1], axis=1).reshape(-1)
    padded = np.append(prefix, 0)
    low, high = np.minimum.reduceat(padded, bounds)[::2], np.maximum.reduceat(padded, bounds)[::2]
    plain = low == high
    found = [(begin[plain], end[plain], low[plain])]
    nested = []
    for a, b in zip(begin[~plain].tolist(), end[~plain].tolist(), strict=True):
        stack = []  # (first, length)
        for at, length in enumerate([*prefix[a + 1 : b + 1].tolist(), 0], a + 1):
            first = at - 1
            while stack and stack[-1][1] > length:
                first, above = stack.pop()
                nested.append((first, at - 1, above))
            if length >= LEAST and (not stack or stack[-1][1] < length):
                stack.append((first, length))
    if nested:
        found.append(tuple(np.array(x) for x in zip(*nested, strict=True)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def maximal_repeats(span: np.ndarray, prefix: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The intervals whose occurrences differ to the left."""
    first, last, length = intervals(prefix)
    changes = np.zeros(len(left), np.int64)
    changes[1:] = (left[1:] != left[:-1]) | (left[1:] < 0)
    changes = np.cumsum(changes)
    diverse = (changes[last] > changes[first]) | (left[first] < 0) if len(first) else np.empty(0, np.bool_)
    return first[diverse], last[diverse], length[diverse]


def _bucket_repeats(rows: pa.Table):
    """Occurrences of all maximal repeats in a bucket: group, span, offset, length; with the spans' id, chunk and number."""
    ids, chunks, numbers, counts, texts = [], [], [], [], []
    for chunk, data in zip(rows.column("chunk").to_pylist(), rows.column("data").to_pylist(), strict=True):
        head = int.from_bytes(data[:8], "little")
        i, step, count = unpack(data[8 : 8 + head], "<i8", "<u4", "<u1")
        count = count.astype(np.int64)
        lengths = count - 1 + LEAST
        flat, at = np.frombuffer(data, np.uint8, offset=8 + head), np.cumsum(lengths) - lengths
        padded = np.zeros((len(i), _WIDEST), np.uint8)
        inside = np.arange(_WIDEST) < lengths[:, None]
        padded[inside] = flat[: int(lengths.sum())]
        ids.append(i), chunks.append(np.full(len(i), chunk)), numbers.append(np.cumsum(step.astype(np.int64)))
        counts.append(count), texts.append(padded)
    ids, chunks, numbers, counts = (np.concatenate(x) for x in (ids, chunks, numbers, counts))
    span, offset, prefix, left = suffixes(np.concatenate(texts), counts)
    first, last, length = maximal_repeats(span, prefix, left)
    size = last - first + 1
    member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    group = np.repeat(np.arange(len(first)), size)
    return group, span[member], offset[member], np.repeat(length, size), ids, chunks, numbers


def _judge(bucket: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Which strings of each span belong to a repeat that a smaller document has."""
    group, span, offset, length, ids, chunks, numbers = _bucket_repeats(rows)
    mask = np.zeros(len(ids), np.uint64)
    if len(group):
        least = np.minimum.reduceat(ids[span], np.nonzero(_first_of(group))[0])[group]
        later = ids[span] > least
        strings = (length[later] - LEAST + 1).astype(np.uint64)
        bits = ((np.uint64(1) << strings) - np.uint64(1)) << offset[later].astype(np.uint64)
        np.bitwise_or.at(mask, span[later], bits)
    hit = mask > 0
    yield blob_rows(_replies(_REMOVED, chunks[hit], numbers[hit].astype("<u4"), mask[hit].astype("<u4")))


def _apply(chunk: Chunk, replies: list[bytes]) -> list[np.ndarray]:
    """Per document of a chunk, whether each byte is removed."""
    spans = spans_of(chunk.texts)
    mask = np.where(_leaders(spans, chunk.ids), 0, 2**32 - 1).astype(np.uint64)
    for data in replies:
        number, bits = unpack(data, "<u4", "<u4")
        mask[number] |= bits.astype(np.uint64)  # a number is in a reply once
    sizes = np.array([len(t) + 1 for t in chunk.texts], np.int64)
    first = np.cumsum(sizes) - sizes
    edge = np.zeros(int(sizes.sum()) + 1, np.int32)
    base = first[spans.doc] + spans.start
    for k in range(_PER):
        at = base[((mask >> np.uint64(k)) & np.uint64(1)).astype(bool) & (spans.count > k)] + k
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LEAST, -1)
    gone = np.cumsum(edge)[:-1] > 0
    return [gone[a : a + n - 1] for a, n in zip(first.tolist(), sizes.tolist(), strict=True)]


def _runs(gone: np.ndarray) -> np.ndarray:
    """The maximal removed runs, as pairs of begin and end."""
    change = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
    return np.stack([np.nonzero(change == 1)[0], np.nonzero(change == -1)[0]], axis=1)


def _texts(table: ChunkStore) -> tuple[DataFrame, DataFrame, int]:
    """Stored replies of the first comparison, the answers with span texts (not stored), and the number of buckets."""
    buckets = bucket_count(table)
    sent = each_chunk(table, lambda chunk: _send(chunk, buckets), BLOBS)
    compared = store(by_key(sent, "bucket", _compare, BLOBS), "compared")
    asked = compared.filter(F.col("bucket") == _ASKED)
    answers = with_replies(table, asked, lambda chunk, data: _answer(chunk, data, buckets), BLOBS, every=False)
    return compared, answers, buckets


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (of the input's order), ``id``, the ``text`` kept (binary) and the removed ``spans`` (offsets in bytes)."""
    return _finish(store_chunks(docs, id_col, text_col), _kept, "row bigint, id bigint, text binary, spans array<struct<begin:bigint,end:bigint>>")


def _finish(table: ChunkStore, show, schema: str) -> DataFrame:
    compared, answers, _ = _texts(table)
    judged = store(by_key(answers, "bucket", _judge, BLOBS), "judged")
    replies = compared.filter(F.col("bucket") == _REMOVED).unionByName(judged)
    return with_replies(table, replies, show, schema)


def _kept(chunk: Chunk, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for number, gone in enumerate(_apply(chunk, replies)):
        raw = np.frombuffer(chunk.texts[number], np.uint8)
        spans = [{"begin": a, "end": b} for a, b in _runs(gone).tolist()]
        key = None if chunk.ids[number] == NO_ID else int(chunk.ids[number])
        arrays = [pa.array([int(chunk.rows[number])]), pa.array([key], pa.int64()), pa.array([raw[~gone].tobytes()]), pa.array([spans], kind)]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "text", "spans"])


def repeats_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""

    def show(chunk: Chunk, replies: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = []
        for number, gone in enumerate(_apply(chunk, replies)):
            raw = np.frombuffer(chunk.texts[number], np.uint8)
            key = None if chunk.ids[number] == NO_ID else int(chunk.ids[number])
            kept = hashlib.sha256(raw[~gone].tobytes()).hexdigest()
            rows.append((key, len(raw), int(gone.sum()), len(_runs(gone)), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*rows, strict=True) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    return _finish(store_chunks(docs, id_col, text_col), show, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal repeats among different spans with one anchor: ``bucket``, ``group``, ``length``, ``chunk``, ``span``, ``offset``, ``id``.

    Not all groups of the corpus: equal spans count once, as that of the smallest id, and repeats end with their span.
    """

    def show(bucket: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        group, span, offset, length, ids, chunks, numbers = _bucket_repeats(rows)
        n = len(group)
        yield pa.RecordBatch.from_pydict(
            {"bucket": np.full(n, bucket), "group": group, "length": length, "chunk": chunks[span], "span": numbers[span], "offset": offset, "id": ids[span]}
        )

    _, answers, _ = _texts(store_chunks(docs, id_col, text_col))
    return by_key(answers, "bucket", show, "bucket bigint, group bigint, length bigint, chunk bigint, span bigint, offset bigint, id bigint")
