"""Substring deduplication by hashing lines, paragraphs or sentences.

A text is cut into units: paragraphs (at blank lines), lines, or sentences (lines cut after ``.``, ``!``, ``?`` or
``…`` and white space, so that a passage pasted into a line is found too). A unit is normalised (lower case, white
space runs to one space, trimmed) and hashed to 128 bits. Of equal units the earliest stays: that of the smallest id,
then of the earliest place; the others go, with the white space behind them. Blank units are no units.

A run of neighbouring units that would go is spared if it has fewer than ``least_words`` words: short units agree by
chance. Offsets are those of the original text, in bytes of UTF-8.

Digests travel packed, one of each per chunk, so a unit that a third of all documents has costs a bucket one entry for
each chunk. Null texts are empty; a null id is larger than any other; of rows with equal ids the first of the input is
the earlier one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from chatterloom.llm.chunks import (
    BLOBS, NO_ID, Chunk, blob_rows, bucket_count, by_key, each_chunk, pack, split_by, store_chunks, unpack, with_replies,
)
from chatterloom.llm.common import store

# A unit, then the white space up to the next one.
UNITS = {
    "paragraph": re.compile(r"\S(?:.*?)(?=\n[^\S\n]*\n|\Z)", re.S),
    "line": re.compile(r"\S[^\n]*"),
    "sentence": re.compile(r"\S(?:[^\n.!?…]|[.!?…](?!\s))*[.!?…]*"),
}
_HIGH = ("<u8", 6)


def units_of(text: str, unit: str) -> list[tuple[int, int, str]]:
    """Begin and end (characters) and the normalised form of every unit."""
    return [(m.start(), m.end(), " ".join(m.group().lower().split())) for m in UNITS[unit].finditer(text)]


class _Units:
    """All units of a chunk, numbered: document, place, words and digest."""

    def __init__(self, chunk: Chunk, unit: str):
        self.texts = [t.decode("utf-8", "replace") for t in chunk.texts]
        doc, self.place, words, digests = [], [], [], []
        for number, text in enumerate(self.texts):
            for begin, end, normal in units_of(text, unit):
                doc.append(number)
                self.place.append((begin, end))
                words.append(normal.count(" ") + 1)
                digests.append(xxhash.xxh3_128_digest(normal.encode("utf-8", "replace")))
        both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        self.doc, self.words = np.array(doc, np.int64), np.array(words, np.int64)
        self.low, self.high = both[:, 0].copy(), both[:, 1] & np.uint64(2**48 - 1)
        self.ids = chunk.ids[self.doc]

    def leaders(self) -> np.ndarray:
        """The earliest unit of each digest in this chunk."""
        order = np.lexsort((np.arange(len(self.doc)), self.ids, self.high, self.low))
        fresh = np.ones(len(order), np.bool_)
        fresh[1:] = (self.low[order][1:] != self.low[order][:-1]) | (self.high[order][1:] != self.high[order][:-1])
        leads = np.zeros(len(order), np.bool_)
        leads[order[fresh]] = True
        return leads


def _send(chunk: Chunk, unit: str, buckets: int) -> Iterator[pa.RecordBatch]:
    units = _Units(chunk, unit)
    number = np.nonzero(units.leaders())[0]
    order, known, cuts = split_by((units.low[number] % np.uint64(buckets)).astype(np.int64))
    rows = []
    for b, first, last in zip(known.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        one = number[order[first:last]]
        step = np.diff(one, prepend=0).astype("<u4")
        rows.append((b, chunk.number, pack(units.low[one], (units.high[one], _HIGH[1]), units.ids[one], step)))
    yield blob_rows(rows)


def _compare(bucket: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    parts = []
    for chunk, data in zip(rows.column("chunk").to_pylist(), rows.column("data").to_pylist(), strict=True):
        low, high, ids, step = unpack(data, "<u8", _HIGH, "<i8", "<u4")
        parts.append((low, high, ids, np.full(len(ids), chunk), np.cumsum(step.astype(np.int64))))
    low, high, ids, chunk, number = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.lexsort((number, chunk, ids, high, low))
    later = np.zeros(len(order), np.bool_)
    later[1:] = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
    gone = order[later]
    order, known, cuts = split_by(chunk[gone])
    found = number[gone][order].astype("<u4")
    yield blob_rows([(bucket, c, pack(found[a:b])) for c, a, b in zip(known.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)])


def _apply(chunk: Chunk, replies: list[bytes], unit: str, least_words: int) -> Iterator[pa.RecordBatch]:
    units = _Units(chunk, unit)
    gone = ~units.leaders()
    for data in replies:
        gone[unpack(data, "<u4")[0]] = True
    # Runs of units that would go, within a document.
    edge = np.ones(len(gone), np.bool_)
    edge[1:] = (gone[1:] != gone[:-1]) | (units.doc[1:] != units.doc[:-1])
    run = np.cumsum(edge) - 1
    if len(gone):
        gone &= np.bincount(run, units.words)[run] >= least_words
    cuts = np.searchsorted(units.doc, np.arange(len(units.texts) + 1))
    rows = []
    for number, text in enumerate(units.texts):
        mine = range(cuts[number], cuts[number + 1])
        kept, at, spans = [], 0, []
        for u in mine:
            if gone[u]:
                begin = units.place[u][0]
                end = units.place[u + 1][0] if u + 1 in mine else len(text)
                kept.append(text[at:begin])
                at = end
                if spans and spans[-1][1] == begin:
                    spans[-1][1] = end
                else:
                    spans.append([begin, end])
        kept.append(text[at:])
        key = None if chunk.ids[number] == NO_ID else int(chunk.ids[number])
        n_gone = int(gone[cuts[number] : cuts[number + 1]].sum())
        rows.append((int(chunk.rows[number]), key, "".join(kept), len(mine), n_gone, _in_bytes(text, spans)))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
    columns = zip(*rows, strict=True) if rows else ((),) * 6
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "text", "n_units", "n_removed", "removed"])


def _in_bytes(text: str, spans: list[list[int]]) -> list[dict[str, int]]:
    places, at, size = [], 0, 0
    for place in (p for span in spans for p in span):
        size += len(text[at:place].encode("utf-8", "replace"))
        at = place
        places.append(size)
    return [{"begin": a, "end": b} for a, b in zip(places[::2], places[1::2], strict=True)]


def deduplicate_units(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", least_words: int = 1
) -> DataFrame:
    """Per row: ``row`` (the input's order), ``id``, ``text`` kept, ``n_units``, ``n_removed``, ``removed`` (byte offsets)."""
    table = store_chunks(docs, id_col, text_col)
    buckets = bucket_count(table, 256 << 20)
    sent = each_chunk(table, lambda chunk: _send(chunk, unit, buckets), BLOBS)
    replies = store(by_key(sent, "bucket", _compare, BLOBS), "later_units")
    schema = "row bigint, id bigint, text string, n_units bigint, n_removed bigint, removed array<struct<begin:bigint,end:bigint>>"
    return with_replies(table, replies, lambda chunk, data: _apply(chunk, data, unit, least_words), schema)
