"""Web archives in ZIP packages: written per partition, read back by ranges without extraction.

A package holds ``archive/data.warc.gz`` and ``indexes/index.cdx`` as stored members, so
that a record is a byte range of the package. Every record is a gzip member of its own,
as is usual for WARC files. The index has a line for each record: its offset in the WARC
member and its length.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch
from sentloom.sources.staging import staging_path

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
# Payloads at least so long are stored once; the others of the same bytes revisit it.
MIN_REVISIT = 1000
# Bytes after which a task begins another package; one package is one task's work when read.
PACKAGE_BYTES = 64 << 20
# Tasks that read packages back, at most; each opens one after another.
READ_TASKS = 10_000
# The pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed values of the ZIP format: signatures, and the marks of fields that ZIP64 holds.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MARK32, MARK16 = 0xFFFFFFFF, 0xFFFF


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    return fs.FileSystem.from_uri(uri)


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit that refers to another page's."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        *([f"Page-Id: {page_id}"] if page_id is not None else []),
        *([f"WARC-Profile: {PROFILE}", f"Refers-To-Page-Id: {refers_to}"] if revisit else []),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class PackageWriter:
    """A package that is written from front to back, straight to the shared folder."""

    def __init__(self, folder: str):
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"  # another name for each attempt of a task
        self.uri, self.records, self.size, self.index = f"{folder}/{name}", 0, 0, []
        self.stream = store.open_output_stream(f"{path}/{name}")
        self.package = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.package.open(WARC_MEMBER, "w", force_zip64=True)

    def add(self, record: bytes) -> None:
        record = gzip.compress(record, mtime=0)
        self.member.write(record)
        self.index.append(f"{self.size} {len(record)}\n")
        self.size += len(record)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.package.writestr(INDEX_MEMBER, "".join(self.index))
        self.package.close()
        self.stream.close()
        return self.uri, len(self.index)


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, digest, refers_to) as packages under ``folder``; the list of packages.

    Only packages of tasks that came to their end are listed, so what a lost task left
    behind is never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = [], None
        for batch in batches:
            for row in zip(*(c for c in batch.columns)):
                now = now or PackageWriter(folder)
                page_id, url, payload, digest, refers_to = (v.as_py() for v in row)
                now.add(warc_record(page_id, url, payload, digest, refers_to))
                if now.size >= PACKAGE_BYTES:
                    done.append(now.close())
                    now = None
        if now:
            done.append(now.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["package", "n_records"])

    return records.mapInArrow(write, "package string, n_records long")


@dataclass
class Member:
    """A member of a package: its name, where its bytes begin, how many there are, and whether they are stored."""

    name: str
    offset: int
    size: int
    stored: bool


class PackageReader:
    """The directory of a ZIP file, read from its end, and ranges of its stored members."""

    def __init__(self, file):
        self.file = file
        self.length = file.size()
        self.members = {m.name: m for m in self._directory()}

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def _end(self) -> tuple[int, int, int]:
        """Number of entries, size and place of the central directory."""
        start = max(0, self.length - 22 - MARK16)  # a comment of at most 65535 bytes may follow
        tail = self._at(start, self.length - start)
        at = tail.rfind(END)
        while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at)  # the signature may also occur in the comment
        if at < 0:
            raise ValueError("no end of a ZIP directory")
        count, size, offset = struct.unpack_from("<HII", tail, at + 10)
        if count == MARK16 or size == MARK32 or offset == MARK32:
            locator = self._at(start + at - 20, 20) if start + at >= 20 else b""
            if locator[:4] == LOCATOR64:
                record = self._at(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != END64:
                    raise ValueError("no ZIP64 end record where its locator points")
                count, size, offset = struct.unpack_from("<QQQ", record, 32)
        return count, size, offset

    def _directory(self) -> Iterator[Member]:
        count, size, offset = self._end()
        data, at = self._at(offset, size), 0
        for _ in range(count):
            if data[at:at + 4] != CENTRAL:
                raise ValueError("broken ZIP directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, unpacked, n, extra, comment = struct.unpack_from("<IIHHH", data, at + 20)
            local = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            field = data[at + 46 + n:at + 46 + n + extra]
            while len(field) >= 4:
                kind, length = struct.unpack_from("<HH", field)
                if kind == 1:  # ZIP64: only the marked fields, in this order
                    body, values = field[4:4 + length], []
                    for value in (unpacked, packed, local):
                        if value == MARK32:
                            value, body = struct.unpack_from("<Q", body)[0], body[8:]
                        values.append(value)
                    unpacked, packed, local = values
                field = field[4 + length:]
            head = self._at(local, 30)
            if head[:4] != LOCAL:
                raise ValueError(f"no local header of {name}")
            # The local header's own lengths: its extra field may differ from the directory's.
            skip = sum(struct.unpack_from("<HH", head, 26))
            yield Member(name, local + 30 + skip, packed, method == 0 and not flags & 1)
            at += 46 + n + extra + comment

    def read(self, name: str, offset: int = 0, size: int | None = None) -> bytes:
        """A range of a stored member."""
        member = self.members[name]
        if not member.stored:
            raise ValueError(f"{name} is compressed or encrypted")
        size = member.size - offset if size is None else size
        if offset < 0 or size < 0 or offset + size > member.size:
            raise ValueError(f"bytes outside of {name}")
        return self._at(member.offset + offset, size)

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Headers and block of each record in the index."""
        for line in self.read(INDEX_MEMBER).decode().splitlines():
            offset, size = map(int, line.split())
            try:
                record = gzip.decompress(self.read(WARC_MEMBER, offset, size))
            except (OSError, EOFError, zlib.error) as error:
                raise ValueError(f"damaged record at {offset}") from error
            head, _, rest = record.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError("the index does not point to a record")
            headers = dict(x.split(": ", 1) for x in lines)
            yield headers, rest[: int(headers["Content-Length"])]


def read_packages(packages: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload of all records of (package).

    The digest of a response is computed from the bytes read, and must be the one that
    was noted; a revisit has the noted length and digest of the payload it stands for,
    and no payload.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_store(uri)
                with store.open_input_file(path) as file:
                    for headers, block in PackageReader(file).records():
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rsplit(b"Content-Length: ", 1)[1])
                        noted, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                        if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != noted):
                            raise ValueError(f"damaged payload in {uri}")
                        number = lambda name: int(headers[name]) if name in headers else None
                        rows.append((number("Page-Id"), headers["WARC-Target-URI"], length, noted, kind, number("Refers-To-Page-Id"), payload if kind == "response" else None))
                        size += len(payload)
                        if len(rows) >= 1000 or size >= 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
        yield batch_of(rows)

    return packages.select("package").mapInArrow(read, schema)


def archive_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """What is to be written for each page: page_id, url, payload, digest, refers_to (NULL for a response).

    Digests decide which payloads are equal; the largest id of each is found before the
    pages are joined with it, and pages that many others equal are a skewed join at worst.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    copied = (
        rows.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    # A page that is the first itself refers to nothing, also where its id occurs twice.
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(copied, "digest", "left").select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write a record for each page into packages in the shared folder and read all of them back.

    Of pages with the same payload (the html in UTF-8, NULL: empty) of at least
    ``MIN_REVISIT`` bytes, that with the largest page_id is a response and the others
    revisit it; shorter payloads are responses. If the largest id occurs more than once,
    its rows are all responses; a NULL id is never the largest, and pages that are alike
    and have no id are all responses. A NULL url is empty. Repeated rows have a record
    each; an empty table gives no package and no rows; other columns are not read.
    """
    spark = pages.sparkSession
    packages = Scratch(spark).write(write_packages(archive_records(pages), staging_path(spark, "warc")), "packages")
    return read_packages(packages.repartition(min(max(1, packages.count()), READ_TASKS)))
