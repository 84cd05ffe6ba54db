"""Packages: round trips, ZIP64 directories, ranges, and what is refused."""

import gzip
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from sentloom.llm import warc_zip


def reader(data):
    return warc_zip.PackageReader(pa.BufferReader(data))


def package(members, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


def test_members_and_ranges():
    r = reader(package({"a": b"0123456789", "b/ü": b"", "c": b"xyz"}, comment=b"has PK\x05\x06 inside" + b"!" * 30))
    assert set(r.members) == {"a", "b/ü", "c"}
    assert (r.read("a"), r.read("a", 3, 4), r.read("b/ü"), r.read("c", 3)) == (b"0123456789", b"3456", b"", b"")
    for bad in ((-1, 2), (0, 11), (8, 3)):
        with pytest.raises(ValueError):
            r.read("a", *bad)


def test_zip64(monkeypatch):
    """With the limits of the old fields lowered, sizes, offsets and the end record are all ZIP64."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 5)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = package({f"m{i}": bytes([65 + i]) * (10 + i) for i in range(5)}, comment=b"end")
    assert warc_zip.END64 in data and warc_zip.LOCATOR64 in data
    r = reader(data)
    assert {n: r.read(n) for n in r.members} == {f"m{i}": bytes([65 + i]) * (10 + i) for i in range(5)}


def test_refused():
    with pytest.raises(ValueError):
        reader(b"no package at all")
    with pytest.raises(ValueError):
        reader(package({"a": b"x" * 100}, method=zipfile.ZIP_DEFLATED)).read("a")


def test_records_are_read_by_range(spark, tmp_path):
    """No more of a package is read than its directory, its index and the records asked for."""
    records = pages(spark, [(i, "u", chr(97 + i) * 5000) for i in range(20)]).coalesce(1).selectExpr(
        "page_id", "url", "cast(html as binary) payload", "sha1(html) digest", "cast(null as long) refers_to")
    uri = warc_zip.write_packages(records, f"file://{tmp_path}/r").collect()[0]["package"]
    asked = []

    class Watched(warc_zip.PackageReader):
        def _at(self, offset, size):
            asked.append(size)
            return super()._at(offset, size)

    r = Watched(pa.BufferReader(open(uri.removeprefix("file://"), "rb").read()))
    lines = r.read(warc_zip.INDEX_MEMBER).decode().splitlines()
    assert len(lines) == 20
    first = [int(x) for x in lines[7].split()]
    asked.clear()
    next(r.records())
    assert max(asked[1:]) <= max(int(x.split()[1]) for x in lines)
    assert b"h" * 5000 in gzip.decompress(r.read(warc_zip.WARC_MEMBER, *first))


def test_empty_package():
    assert reader(package({})).members == {}


def pages(spark, rows, schema="page_id long, url string, html string"):
    return spark.createDataFrame(rows, schema)


def test_round_trip(spark):
    long_a, long_b = "ä\r\n\r\n" * 400, "Content-Length: 5\r\n\r\n" * 60
    rows = [(1, "http://a/ x\n", long_a), (2, "http://b", long_a), (3, None, long_a), (3, None, long_a), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
            (7, "u", ""), (8, "u", long_b), (None, "u", long_b), (None, "v", "c" * 1000), (None, "v", "c" * 1000), (9, "w", "d" * 999), (10, "w", "d" * 999)]
    got = warc_zip.archive_pages(pages(spark, rows)).collect()
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        alike = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(alike, default=None) if len(data) >= 1000 else None
        revisit = first is not None and page_id != first
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    assert next(r for r in got if r["page_id"] == 1)["url"] == "http://a/%20x%0A"


def test_many_packages(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", 3000)
    rows = [(i, f"u{i}", chr(97 + i % 26) * (i * 7)) for i in range(200)]
    got = warc_zip.archive_pages(pages(spark, rows).repartition(3)).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(i, i * 7) for i in range(200)]


def test_damage_is_found(spark, tmp_path):
    records = pages(spark, [(1, "u", "x" * 50)]).selectExpr("page_id", "url", "cast(html as binary) payload", "sha1(html) digest", "cast(null as long) refers_to")
    written = warc_zip.write_packages(records, f"file://{tmp_path}/p").collect()
    path = [r["package"] for r in written if r["package"]][0].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    place = reader(bytes(data)).members[warc_zip.WARC_MEMBER].offset
    data[place + 60] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged record"):
        warc_zip.read_packages(spark.createDataFrame([(f"file://{path}",)], "package string")).collect()


def test_empty_and_other_columns(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet")
    assert warc_zip.archive_pages(table.limit(0)).collect() == []
    more = table.selectExpr("*", "1 as digest", "'x' as payload", "2 as n", "3 as first")
    assert warc_zip.archive_pages(more).count() == table.count()
