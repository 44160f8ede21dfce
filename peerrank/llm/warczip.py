"""WARC records in ZIP packages, read back by range without extraction.

Package: a ZIP file with two stored (never compressed) members,
``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (one line per record: page id, offset and length of its
gzip member inside the WARC member).  Stored members make every record a plain
byte range of the package.

Writing: pages with equal payloads are found by digest; the smallest page_id
of a payload writes a response, every other one a revisit that carries the
payload's digest, its length and the page it refers to, but no payload.

Reading: the end of the file gives the central directory (through the ZIP64
locator and record where the package uses them); the directory gives the
members (ZIP64 extra fields included); each member's local header gives where
its bytes begin; the index then gives each record's range.  A response's
payload is checked against its digest.

Defined cases: a null html is an empty payload; a null page_id stays null (it
refers to the smallest page of its payload, or is a response if there is
none); rows that repeat a page_id with one payload are all written with that
page's type; an empty table gives no package and an empty report; other
columns than page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, join_spread, shared_folder, small_batches, written
from .storage import new_file, random_access, read_range

# Signatures and sizes of the ZIP format.
LOCAL_HEADER, CENTRAL_HEADER, END_RECORD = 0x04034B50, 0x02014B50, 0x06054B50
ZIP64_END_RECORD, ZIP64_LOCATOR, ZIP64_EXTRA = 0x06064B50, 0x07064B50, 0x0001
LOCAL_SIZE, CENTRAL_SIZE, END_SIZE, ZIP64_END_SIZE, ZIP64_LOCATOR_SIZE = 30, 46, 22, 56, 20
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
REPORT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# --- ZIP ---------------------------------------------------------------------


class ZipWriter:
    """Stored members, streamed: sizes and checksums come after the data (data
    descriptors) and in the central directory.  Fields that need it (or all of
    them with ``zip64``) go to ZIP64 records."""

    def __init__(self, out: pa.NativeFile, zip64: bool = False) -> None:
        self.out, self.zip64 = out, zip64
        self.at = 0
        self.done: list[tuple[bytes, int, int, int]] = []
        self.open: tuple[bytes, int] | None = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.open = (name.encode(), self.at)
        self.crc = self.size = 0
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)  # announces 8-byte sizes in the descriptor
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL_HEADER, 45, 0x0808, 0, 0, 0x21, 0, FULL32, FULL32, len(self.open[0]), len(extra)))
        self._put(self.open[0] + extra)

    def write(self, data: bytes) -> int:
        """Appends to the open member; returns the offset inside it."""
        offset = self.size
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)
        return offset

    def end(self) -> None:
        name, start = self.open
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, self.size, self.size))
        self.done.append((name, self.crc, self.size, start))

    def close(self) -> None:
        directory = self.at
        for name, crc, size, start in self.done:
            big = self.zip64 or size >= FULL32, self.zip64 or start >= FULL32
            values = ([size, size] if big[0] else []) + ([start] if big[1] else [])
            extra = struct.pack(f"<HH{len(values)}Q", ZIP64_EXTRA, 8 * len(values), *values) if values else b""
            short = FULL32 if big[0] else size
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL_HEADER, 45, 45, 0x0808, 0, 0, 0x21, crc, short, short, len(name),
                                  len(extra), 0, 0, 0, 0, FULL32 if big[1] else start) + name + extra)
        size, n = self.at - directory, len(self.done)
        if self.zip64 or n >= FULL16 or size >= FULL32 or directory >= FULL32:
            record = self.at
            self._put(struct.pack("<IQHHIIQQQQ", ZIP64_END_RECORD, ZIP64_END_SIZE - 12, 45, 45, 0, 0, n, n, size, directory))
            self._put(struct.pack("<IIQI", ZIP64_LOCATOR, 0, record, 1))
            n, size, directory = FULL16, FULL32, FULL32
        self._put(struct.pack("<IHHHHIIH", END_RECORD, 0, 0, n, n, size, directory, 0))


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


class ZipReader:
    """Locates members through the central directory; reads byte ranges."""

    def __init__(self, f: pa.NativeFile) -> None:
        self.f = f
        start, size, count = self._directory_place()
        self.members = {m.name: m for m in self._directory(read_range(f, start, size), count)}

    def _directory_place(self) -> tuple[int, int, int]:
        length = self.f.size()
        tail_size = min(length, END_SIZE + FULL16)  # the end record may be followed by a comment
        tail = read_range(self.f, length - tail_size, tail_size)
        at = tail.rfind(struct.pack("<I", END_RECORD))
        while at >= 0:
            if at + END_SIZE <= len(tail) and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
            at = tail.rfind(struct.pack("<I", END_RECORD), 0, at)
        if at < 0:
            raise ValueError("no end record: not a ZIP package")
        count, size, start = struct.unpack_from("<HII", tail, at + 10)
        if FULL16 != count and FULL32 not in (size, start):
            return start, size, count
        place = length - tail_size + at - ZIP64_LOCATOR_SIZE
        signature, _, record, _ = struct.unpack("<IIQI", read_range(self.f, place, ZIP64_LOCATOR_SIZE)) if place >= 0 else (0, 0, 0, 0)
        if signature != ZIP64_LOCATOR:
            if FULL32 in (size, start):
                raise ValueError("ZIP64 locator missing")
            return start, size, count
        fields = struct.unpack("<IQHHIIQQQQ", read_range(self.f, record, ZIP64_END_SIZE))
        if fields[0] != ZIP64_END_RECORD:
            raise ValueError("ZIP64 end record missing")
        return fields[9], fields[8], fields[7]

    @staticmethod
    def _directory(data: bytes, count: int) -> Iterator[Member]:
        at = 0
        for _ in range(count):
            f = struct.unpack_from("<IHHHHHHIIIHHHHHII", data, at)
            if f[0] != CENTRAL_HEADER:
                raise ValueError("central directory entry expected")
            size, header = f[9], f[16]
            name = data[at + CENTRAL_SIZE : at + CENTRAL_SIZE + f[10]]
            extra = data[at + CENTRAL_SIZE + f[10] : at + CENTRAL_SIZE + f[10] + f[11]]
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<HH", extra)
                if kind == ZIP64_EXTRA:  # holds, in this order, only the fields that are full above
                    values = list(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                    size = values.pop(0) if f[9] == FULL32 else size
                    if f[8] == FULL32:
                        values.pop(0)
                    header = values.pop(0) if f[16] == FULL32 else header
                extra = extra[4 + length :]
            yield Member(name.decode("utf-8" if f[3] & 0x800 else "cp437"), f[4], size, header)
            at += CENTRAL_SIZE + f[10] + f[11] + f[12]

    def place(self, name: str) -> tuple[int, int]:
        """First byte and size of a stored member."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = struct.unpack("<IHHHHHIIIHH", read_range(self.f, m.header, LOCAL_SIZE))
        if head[0] != LOCAL_HEADER:
            raise ValueError(f"no local header for {name}")
        return m.header + LOCAL_SIZE + head[9] + head[10], m.size


# --- WARC --------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": "".join((url or "").split()) or "urn:none",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


@dataclass(frozen=True)
class WarcRecord:
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @property
    def digest(self) -> str:
        return self.fields["warc-payload-digest"].removeprefix("sha1:")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def parse_record(data: bytes) -> WarcRecord:
    if not data.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    return WarcRecord(fields, _fields(http), payload)


def _page_of(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def read_index(zipped: ZipReader) -> list[dict]:
    start, size = zipped.place(INDEX_MEMBER)
    return [json.loads(x) for x in read_range(zipped.f, start, size).decode().split("\n") if x]


def read_record(zipped: ZipReader, entry: dict, place: tuple[int, int] | None = None) -> WarcRecord:
    """One record of the package, by its byte range; ``place``: that of the
    WARC member, if it was read before."""
    start, size = place or zipped.place(WARC_MEMBER)
    if entry["offset"] + entry["length"] > size:
        raise ValueError("index points past its member")
    record = parse_record(gzip.decompress(read_range(zipped.f, start + entry["offset"], entry["length"])))
    if record.fields["warc-type"] == "response" and payload_digest(record.payload) != record.digest:
        raise ValueError(f"payload does not match its digest: {record.fields['warc-record-id']}")
    return record


# --- Spark -------------------------------------------------------------------


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html with ``revisit`` and ``refers_to``: of the pages with
    one payload of at least ``least_bytes`` the smallest page_id responds."""
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.unhex(F.sha1(F.encode("html", "utf-8"))))
    firsts = (
        keyed.filter(F.octet_length("html") >= least_bytes).select("digest", "page_id")
        .groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    typed = join_spread(keyed, written(firsts, "warc-repeated"), "digest", "n", ["page_id", "url"])
    revisit = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))
    return typed.select(
        "page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("refers_to")).alias("refers_to")
    )


def _write_packages(folder: str, zip64: bool, level: int, package_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in small_batches(batches, 128) for r in b.to_pylist())
        row, nth, part = next(rows, None), 0, TaskContext.get().partitionId()
        while row is not None:
            path, index = f"{folder}/part-{part:06d}-{nth:04d}.zip", []
            with new_file(path) as out:
                zipped = ZipWriter(out, zip64)
                zipped.begin(WARC_MEMBER)
                while row is not None and zipped.size < package_bytes:
                    data = gzip.compress(
                        warc_record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"], row["revisit"], date),
                        level, mtime=0,
                    )
                    index.append(json.dumps({"page_id": row["page_id"], "offset": zipped.write(data), "length": len(data)}))
                    row = next(rows, None)
                zipped.end()
                zipped.begin(INDEX_MEMBER)
                zipped.write("\n".join(index).encode())
                zipped.end()
                zipped.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "records": len(index), "bytes": zipped.at}],
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )
            nth += 1

    return run


def write_packages(pages: DataFrame, folder: str, least_bytes: int = 0, zip64: bool = False, level: int = 1,
                   package_bytes: int = 1 << 28, date: str | None = None) -> list[dict]:
    """Writes every page; returns the manifest, one entry per package.  ``date``
    (``YYYY-MM-DDThh:mm:ssZ``) is when the pages were captured, by default now:
    one date for all records, so that a task that runs again writes the same."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    datetime.strptime(date, "%Y-%m-%dT%H:%M:%SZ")
    bound_batches(pages.sparkSession)
    typed = with_record_types(pages, least_bytes)
    rows = typed.mapInArrow(_write_packages(folder, zip64, level, package_bytes, date), MANIFEST).collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: r["path"])]


def _report_packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in REPORT.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in REPORT.split(", ")])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with random_access(path) as f:
                zipped, out = ZipReader(f), []
                place = zipped.place(WARC_MEMBER)
                for entry in read_index(zipped):
                    r = read_record(zipped, entry, place)
                    revisit = r.fields["warc-type"] == "revisit"
                    out.append((
                        _page_of(r.fields["warc-record-id"]),
                        int(r.http["content-length"]) if revisit else len(r.payload),
                        r.digest, r.fields["warc-type"],
                        _page_of(r.fields["warc-refers-to"]) if revisit else None,
                    ))
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=schema)
                        out = []
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=schema)


def read_packages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per record of the packages."""
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return files.repartition(max(1, len(paths)), "path").mapInArrow(_report_packages, REPORT)


def archive_report(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the packages (by default below the shared folder) and reads them back."""
    spark = pages.sparkSession
    manifest = write_packages(pages, folder or shared_folder(spark, "warc-packages"), **options)
    return read_packages(spark, [m["path"] for m in manifest])
