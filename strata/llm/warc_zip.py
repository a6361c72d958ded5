"""WARC records in ZIP packages (operator 8).

:func:`write_archives` packs records as gzip members of ``archive/data.warc.gz`` beside an index
``indexes/index.cdx`` (a line per record: page id, offset, length), both stored, not deflated, in one
ZIP per file. Equal payloads are kept once: the record with the smallest page id is the response, the
others are revisits that refer to it.

:func:`read_archives` needs nothing but the packages: it reads the end of the file for the end of the
central directory (and, where its fields overflow, the ZIP64 locator and record), parses the central
directory with its ZIP64 extras, finds the stored members, reads the index, and then reads each record
by its byte range. Nothing is extracted.

Scale: payloads are grouped by SHA-1 over (digest, page id) rows only. A package is closed at
``PACKAGE_BYTES``; a task holds one record and one index at a time. Every attempt writes packages under
fresh names and reports them in its rows, so files of lost or repeated attempts are never read.

Defined cases: null html is an empty payload; a payload smaller than ``least`` bytes is always a
response; repeated rows that tie for the smallest page id are all responses; null page ids come last
(a payload that only null ids have is a response each time, with the id written as ``null``); a null
url is written as ``unknown:`` and read back as null; empty input writes no package.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import materialize, spread
from .token_scan import open_folder

PACKAGE_BYTES = 128 << 20
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

# ZIP signatures and the field value that says "see ZIP64".
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


class Member(NamedTuple):
    name: str
    method: int
    stored: int
    size: int
    header_at: int


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- writing


class ZipWriter:
    """Stored members streamed one after another; every member and the directory carry ZIP64 fields."""

    def __init__(self, out: BinaryIO):
        self.out, self.at, self.members = out, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        # sizes and CRC follow in a data descriptor (flag bit 3)
        self.name, self.header_at, self.crc = name.encode(), self.at, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        fixed = struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 33, 0, FULL32, FULL32, len(self.name), len(extra))
        self._write(LOCAL + fixed + self.name + extra)
        self.data_at = self.at

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self._write(data)

    def finish(self) -> None:
        size = self.at - self.data_at
        self._write(b"PK\7\x08" + struct.pack("<IQQ", self.crc, size, size))
        self.members.append((self.name, self.crc, size, self.header_at))

    def close(self) -> None:
        start = self.at
        for name, crc, size, header_at in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, header_at)
            self._write(
                CENTRAL
                + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 33, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32)
                + name
                + extra
            )
        size, end64_at, n = self.at - start, self.at, len(self.members)
        self._write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
        self._write(LOCATOR64 + struct.pack("<IQI", 0, end64_at, 1))
        self._write(END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


def record(page_id: int | None, url: str | None, payload: bytes, response: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record, as a gzip member."""
    name = "null" if page_id is None else str(page_id)
    target = "unknown:" if url is None else " ".join(url.split())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if is_revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{response}>",
        ]
    else:
        body += payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class Package:
    def __init__(self, system, path: str):
        self.path, self.out = path, system.open_output_stream(path)
        self.zip, self.lines = ZipWriter(self.out), []
        self.zip.begin(WARC)

    def add(self, page_id: int | None, data: bytes) -> None:
        self.lines.append(f"{'null' if page_id is None else page_id} {self.zip.at - self.zip.data_at} {len(data)}\n")
        self.zip.write(data)

    def close(self) -> None:
        self.zip.finish()
        self.zip.begin(INDEX)
        self.zip.write("".join(self.lines).encode())
        self.zip.finish()
        self.zip.close()
        self.out.close()


def write_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as packages in the shared folder: a row (package, records) each."""
    folder = fresh_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"))
    firsts = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("f_digest"))
        .groupBy("f_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("same"))
        .where("same > 1")
        .drop("same")
    )
    # equal payloads meet as ids only; pages then meet their own id, so no task gets all pages of a payload
    copies = rows.select(F.col("page_id").alias("c_id"), F.col("digest").alias("c_digest")).dropDuplicates()
    copies = copies.join(firsts, F.col("c_digest") == F.col("f_digest")).select("c_id", "c_digest", "first_id")
    same = (F.col("digest") == F.col("c_digest")) & F.col("page_id").eqNullSafe(F.col("c_id"))
    typed = rows.join(copies, same, "left").select("page_id", "url", "html", "first_id")
    schema = pa.schema([("package", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        package, done = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if package is None:
                    package = Package(system, f"{path}/{uuid.uuid4().hex}.zip")
                body = (r["html"] or "").encode()
                again = r["first_id"] is not None and r["page_id"] != r["first_id"] and len(body) >= least
                package.add(r["page_id"], record(r["page_id"], r["url"], body, r["first_id"], again))
                if package.zip.at >= PACKAGE_BYTES:
                    package.close()
                    done.append((package.path, len(package.lines)))
                    package = None
        if package is not None:
            package.close()
            done.append((package.path, len(package.lines)))
        columns = list(zip(*done)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return materialize(typed.mapInArrow(run, "package string, records long"))


# ---------------------------------------------------------------- reading


def central_directory(f, size: int) -> list[Member]:
    """The members of a ZIP of ``size`` bytes, by range reads at its end only."""
    tail_at = max(0, size - (1 << 16) - 22)
    tail = f.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)  # a signature inside the comment
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, count, length, start = struct.unpack("<HHHHII", tail[at + 4 : at + 20])
    if count == FULL16 or length == FULL32 or start == FULL32:
        where = f.read_at(20, tail_at + at - 20)
        if where[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end64 = f.read_at(56, struct.unpack("<Q", where[8:16])[0])
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<QQQ", end64[32:56])
    data, at, out = f.read_at(length, start), 0, []
    for _ in range(count):
        if data[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, stored, full, n, x, c, header_at = struct.unpack("<10xH8xIIHHH8xI", data[at : at + 46])
        name = data[at + 46 : at + 46 + n].decode()
        extra, fields = data[at + 46 + n : at + 46 + n + x], 0
        while fields + 4 <= len(extra):
            kind, size_of = struct.unpack("<HH", extra[fields : fields + 4])
            if kind == 1:  # ZIP64: only the overflowed fields, in this order
                values = iter(struct.unpack(f"<{size_of // 8}Q", extra[fields + 4 : fields + 4 + size_of // 8 * 8]))
                full = next(values) if full == FULL32 else full
                stored = next(values) if stored == FULL32 else stored
                header_at = next(values) if header_at == FULL32 else header_at
            fields += 4 + size_of
        out.append(Member(name, method, stored, full, header_at))
        at += 46 + n + x + c
    return out


def data_start(f, member: Member) -> int:
    head = f.read_at(30, member.header_at)
    if head[:4] != LOCAL:
        raise ValueError("broken local header")
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    n, x = struct.unpack("<HH", head[26:30])
    return member.header_at + 30 + n + x


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (what follows the HTTP head) of an inflated record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def package_records(system, path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of a package, located by its index."""
    with system.open_input_file(path) as f:
        members = {m.name: m for m in central_directory(f, f.size())}
        index = f.read_at(members[INDEX].size, data_start(f, members[INDEX]))
        base = data_start(f, members[WARC])
        for line in index.decode().splitlines():
            _, offset, length = line.split()
            yield parse_record(zlib.decompress(f.read_at(int(length), base + int(offset)), 31))


def _id(urn: str | None) -> int | None:
    name = (urn or "<urn:page:null>").strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def read_archives(packages: DataFrame) -> DataFrame:
    """A row per record of ``packages`` (package): page_id, url, payload (null in revisits), payload_bytes,
    payload_digest, record_type, refers_to. A response's length and digest are taken from its payload."""
    store = fresh_path(packages.sparkSession, "warc")  # any path in the same store
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(store)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, payload in package_records(system, path):
                    whole = headers["WARC-Type"] == "response"
                    url = headers["WARC-Target-URI"]
                    rows.append(
                        {
                            "page_id": _id(headers["WARC-Record-ID"]),
                            "url": None if url == "unknown:" else url,
                            "payload": payload if whole else None,
                            "payload_bytes": len(payload) if whole else int(headers["X-Payload-Length"]),
                            "payload_digest": sha1_base32(payload) if whole else headers["WARC-Payload-Digest"][5:],
                            "record_type": headers["WARC-Type"],
                            "refers_to": None if whole else _id(headers["WARC-Refers-To"]),
                        }
                    )
                    held += len(payload)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kind = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread(packages.select("package"), packages.count(), "package").mapInArrow(run, kind)
