import base64
import hashlib
import io
import struct
import zipfile

import pytest

from chatterloom.llm import warc

ROWS = [
    (5, "http://a/\n1", "x"), (2, "http://b", "x"), (2, "http://b", "x"), (None, "http://c", "x"),
    (7, None, None), (8, "é", ""), (9, "z", "größe " * 50_000), (10, "y", "größe"), (None, None, "alone"),
]


class Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, offset):
        return self.data[offset : offset + n]


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        if page_id is not None and len(raw) >= least:
            first[raw] = min(first.get(raw, page_id), page_id)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        refers = first.get(raw) if len(raw) >= least and first.get(raw) != page_id else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        yield (page_id, len(raw), digest, "response" if refers is None else "revisit", refers)


def key(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize(("least", "zip64"), [(0, True), (2, False)])
def test_round_trip_with_ties_nulls_and_long_pages(spark, least, zip64):
    pages = spark.createDataFrame([(*r, "w", "v") for r in ROWS], "page_id bigint, url string, html string, digest string, path string")
    manifest = warc.write_packages(pages.repartition(3), least_bytes=least, zip64=zip64, package_bytes=4000)
    assert manifest.count() > 2
    found = warc.read_packages(spark, manifest, payload=True).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=key) == sorted(expected(ROWS, least), key=key)
    texts = {r.page_id: r.payload.decode() for r in found if r.record_type == "response"}
    assert texts[9] == "größe " * 50_000
    # Any ZIP tool can open the packages; the reader can open theirs.
    path = manifest.first().path.removeprefix("file:")
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None and package.namelist() == [warc.ARCHIVE, warc.INDEX]


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_packages(spark, warc.write_packages(none)).collect() == []


def test_given_pages(spark, pages):
    found = warc.read_packages(spark, warc.write_packages(pages)).collect()
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == sorted(expected(rows), key=key)


def test_foreign_zip_directories():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        package.writestr("plain", b"abc" * 10)
        package.writestr("small", b"abc" * 1000, zipfile.ZIP_DEFLATED)
        package.comment = b"a comment with the end mark " + struct.pack("<I", 0x06054B50) + b" in it"
    file = Bytes(out.getvalue())
    plain, small = warc.read_directory(file)
    assert (plain.name, plain.size, plain.stored, small.stored) == ("plain", 30, True, False)
    assert file.read_at(30, warc.data_offset(file, plain)) == b"abc" * 10
    with pytest.raises(ValueError, match="not stored"):
        warc.data_offset(file, small)
    with pytest.raises(ValueError, match="no ZIP directory"):
        warc.read_directory(Bytes(b"nothing"))


def test_zip64_directory():
    file = Bytes(warc.build_zip({"a": b"12345", "b": b"678"}, zip64=True))
    assert struct.pack("<I", 0x06064B50) in file.data
    a, b = warc.read_directory(file)
    assert (a.size, b.size) == (5, 3)
    assert file.read_at(3, warc.data_offset(file, b)) == b"678"


def test_damaged_payload_is_refused():
    raw = warc.build_record(1, "u", b"abc", hashlib.sha1(b"abc").digest(), None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(raw)["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(raw.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"))
