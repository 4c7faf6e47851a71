"""WARC records in ZIP packages: written by tasks, read back by ranges without extraction.

A package is a ZIP file with stored (not deflated) members: ``archive/data.warc.gz``, one gzip member for each record,
and ``indexes/index.jsonl``, one line for each record with its place inside the archive member. A writer task fills a
package in memory up to ``package_bytes`` and writes it under a new name in the shared folder; only packages listed in
the stored manifest count, so an attempt that was lost leaves nothing but an unread file.

The reader takes the end of the file, follows the end-of-central-directory record (and its ZIP64 form), parses the
central directory, finds the archives and indexes, and range-reads records; neighbouring records share one read.

Of records with equal payloads of at least ``least_bytes`` bytes, that with the smallest page_id is a response, the
others revisit it; rows that repeat the smallest page_id are responses too. A null page_id is larger than any other,
and no record refers to one: if all are null, all are responses. A null html is an empty payload.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm.common import file_system, map_arrow, map_pandas, shuffle_partitions, store
from chatterloom.session import scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END, _END64, _LOCATOR, _ENTRY, _LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF
_READ = 4 << 20


# Records


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest_text(sha1)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(raw: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda urn: int(urn.rstrip(">").rpartition(":")[2]) if not urn.endswith(":>") else None
    found = {
        "page_id": number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "payload_bytes": int(_fields(http)["content-length"]),
        "payload": payload if fields["warc-type"] == "response" else None,
    }
    if found["payload"] is not None:
        if digest_text(hashlib.sha1(payload).digest()) != found["payload_digest"] or len(payload) != found["payload_bytes"]:
            raise ValueError(f"record {fields['warc-record-id']}: the payload does not match its digest")
    return found


def pack(raw: bytes) -> bytes:
    member = zlib.compressobj(1, zlib.DEFLATED, 31)
    return member.compress(raw) + member.flush()


# ZIP


@dataclass(frozen=True)
class Member:
    name: str
    offset: int  # of the local header
    size: int
    stored: bool


def build_zip(members: dict[str, bytes], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ``zip64`` puts sizes and offsets into the 64-bit fields even if they are small."""
    out, directory = bytearray(), bytearray()
    zip64 = zip64 or sum(map(len, members.values())) + 4096 > _MAX32
    for name, data in members.items():
        at, label, crc = len(out), name.encode(), zlib.crc32(data)
        size32 = _MAX32 if zip64 else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if zip64 else b""
        out += struct.pack("<IHHHHHIIIHH", _LOCAL, 45, 0, 0, 0, 33, crc, size32, size32, len(label), len(extra))
        out += label + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if zip64 else b""
        directory += struct.pack(
            "<IHHHHHHIIIHHHHHII", _ENTRY, 45, 45, 0, 0, 0, 33, crc, size32, size32, len(label), len(extra), 0, 0, 0, 0,
            _MAX32 if zip64 else at,
        )
        directory += label + extra
    at, n, size = len(out), len(members), len(directory)
    out += directory
    if zip64:
        where = len(out)
        out += struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, size, at)
        out += struct.pack("<IIQI", _LOCATOR, 0, where, 1)
        n, size, at = _MAX16, _MAX32, _MAX32
    return bytes(out + struct.pack("<IHHHHIIH", _END, 0, 0, n, n, size, at, 0))


def read_directory(file) -> list[Member]:
    """The members of a ZIP file (anything with ``size()`` and ``read_at(bytes, offset)``), from its directory alone."""
    size = file.size()
    base = max(0, size - 22 - _MAX16 - 20)
    tail = file.read_at(size - base, base)
    end = tail.rfind(struct.pack("<I", _END))
    while end >= 0 and (len(tail) - end < 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(struct.pack("<I", _END), 0, end)  # the mark can stand in a comment
    if end < 0:
        raise ValueError("no ZIP directory found")
    n, length, start = struct.unpack_from("<HII", tail, end + 10)
    if _MAX16 == n or _MAX32 in (length, start):
        if end >= 20 and struct.unpack_from("<I", tail, end - 20)[0] == _LOCATOR:
            where = struct.unpack_from("<Q", tail, end - 12)[0]
            record = file.read_at(56, where)
            if struct.unpack_from("<I", record)[0] != _END64:
                raise ValueError("the ZIP64 locator points to no ZIP64 record")
            n, length, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, members = file.read_at(length, start), 0, []
    for _ in range(n):
        mark, flags, method, packed, full, label, extra, comment, local = struct.unpack_from("<I4xHH8xIIHHH8xI", raw, at)
        if mark != _ENTRY:
            raise ValueError("the ZIP directory is damaged")
        name = raw[at + 46 : at + 46 + label].decode("utf-8" if flags & 0x800 else "cp437")
        more, end_of = at + 46 + label, at + 46 + label + extra
        while more + 4 <= end_of:
            kind, width = struct.unpack_from("<HH", raw, more)
            if kind == 1:  # 64-bit values, in this order, of the fields that are full
                wide = more + 4
                if full == _MAX32:
                    full, wide = struct.unpack_from("<Q", raw, wide)[0], wide + 8
                if packed == _MAX32:
                    packed, wide = struct.unpack_from("<Q", raw, wide)[0], wide + 8
                if local == _MAX32:
                    local = struct.unpack_from("<Q", raw, wide)[0]
            more += 4 + width
        members.append(Member(name, local, packed, method == 0))
        at = end_of + comment
    return members


def data_offset(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if not member.stored:
        raise ValueError(f"{member.name} is not stored, so its records cannot be range-read")
    mark, label, extra = struct.unpack_from("<I22xHH", file.read_at(30, member.offset))
    if mark != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.offset + 30 + label + extra


def index_lines(file, member: Member) -> Iterator[dict]:
    at, end, rest = data_offset(file, member), 0, b""
    end = at + member.size
    while at < end:
        rest += file.read_at(min(_READ, end - at), at)
        at = min(at + _READ, end)
        *lines, rest = rest.split(b"\n")
        yield from (json.loads(line) for line in lines if line)
    if rest:
        yield json.loads(rest)


# Spark


def _repeated(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Digests that several records share, with the page they refer to; stored, so that Spark knows the size."""
    rows = pages.filter(F.col("n") >= least_bytes)
    shared = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return store(shared.filter("copies > 1").select("digest", "first_id"), "repeated")


def write_packages(
    pages: DataFrame, folder: str | None = None, *, least_bytes: int = 0, package_bytes: int = 32 << 20,
    date: str = "2024-01-01T00:00:00Z", zip64: bool = False,
) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) and returns the stored manifest: ``path``, ``records``, ``bytes``."""
    folder = folder or scratch_path(pages.sparkSession, "packages")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body"), F.unhex(F.sha1(body)).alias("digest"), F.length(body).alias("n"))
    shared = _repeated(rows.select("page_id", "digest", "n"), least_bytes)
    marked = rows.join(shared, "digest", "left")
    refers = F.when((F.col("n") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    marked = marked.select("page_id", "url", "body", "digest", refers.alias("refers_to"))

    def save(records: bytearray, lines: list[str]) -> pa.RecordBatch:
        system, inner = file_system(folder)
        system.create_dir(inner, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        data = build_zip({ARCHIVE: bytes(records), INDEX: "".join(lines).encode()}, zip64)
        with system.open_output_stream(f"{inner}/{name}") as out:
            out.write(data)
        return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [len(lines)], "bytes": [len(data)]})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, lines = bytearray(), []
        for batch in batches:
            for page_id, url, raw, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = pack(build_record(page_id, url, raw, sha1, refers_to, date))
                lines.append(json.dumps({"id": page_id, "offset": len(records), "length": len(record)}) + "\n")
                records += record
                if len(records) >= package_bytes:
                    yield save(records, lines)
                    records, lines = bytearray(), []
        if lines:
            yield save(records, lines)

    return store(map_arrow(marked, work, "path string, records bigint, bytes bigint"), "manifest")


def locate_records(packages: DataFrame) -> DataFrame:
    """``path``, ``offset`` (in the file), ``length`` of every record, from the packages' directories and indexes."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, inner = file_system(path)
                with system.open_input_file(inner) as file:
                    members = {m.name: m for m in read_directory(file)}
                    start = data_offset(file, members[ARCHIVE])
                    rows = [(path, start + line["offset"], line["length"]) for line in index_lines(file, members[INDEX])]
                yield pd.DataFrame(rows, columns=["path", "offset", "length"])

    return map_pandas(packages.select("path"), work, "path string, offset bigint, length bigint")


_RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, path string, offset bigint"


def read_records(places: DataFrame, *, payload: bool = False, block_bytes: int = 1 << 20) -> DataFrame:
    """The records at ``places``, range-read; a package is read in blocks by different tasks. ``payload``: with payloads.

    The places are small beside what is read for them, so the number of tasks is given, not left to their size.
    """
    block, tasks = F.floor(F.col("offset") / block_bytes), shuffle_partitions(places.sparkSession)
    dealt = places.withColumn("block", block).repartition(tasks, "path", "block").sortWithinPartitions("path", "offset")

    def fetch(rows: list[tuple[str, int, int]]) -> Iterator[dict]:
        path, start, _ = rows[0]
        system, inner = file_system(path)
        with system.open_input_file(inner) as file:
            raw = memoryview(file.read_at(rows[-1][1] + rows[-1][2] - start, start))
        for _, offset, length in rows:
            one = parse_record(zlib.decompress(raw[offset - start : offset - start + length], 31))
            if not payload:
                one.pop("payload")
            yield one | {"path": path, "offset": offset}

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            run: list[tuple[str, int, int]] = []
            for row in zip(batch["path"], batch["offset"].tolist(), batch["length"].tolist(), strict=True):
                adjoins = run and row[0] == run[-1][0] and row[1] == run[-1][1] + run[-1][2]
                if run and (not adjoins or row[1] + row[2] - run[0][1] > _READ):
                    yield _frame(fetch(run))
                    run = []
                run.append(row)
            if run:
                yield _frame(fetch(run))

    return map_pandas(dealt.select("path", "offset", "length"), work, _RECORD + (", payload binary" if payload else ""))


def _frame(rows: Iterator[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(list(rows))
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_packages(spark: SparkSession, paths: list[str] | DataFrame, **options) -> DataFrame:
    """All records of packages, given by a manifest or by their paths."""
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")
    return read_records(locate_records(paths.repartition(max(1, spark.sparkContext.defaultParallelism))), **options)
