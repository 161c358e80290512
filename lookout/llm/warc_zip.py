"""WARC records in ZIP packages (operator 2).

*Layout.* A package is a ZIP file with stored (not compressed) members:
``archive/data.warc.gz``, one gzip member per WARC record, and
``indexes/index.json``, one line per record with its place in the archive.

*Writing.* Payloads are compared by their SHA-256; of equal payloads the
record with the smallest id is a response, the others are revisits that name
it and carry no payload. Copies are found by grouping the hashes (combined
before the shuffle), and only hashes that occur more than once are joined
back. Each task streams its rows into packages of bounded size in the shared
folder. A package counts only if it is in the returned list, which is written
through a checkpoint: what a failed attempt leaves behind is never read.

*Reading.* The end record of the file leads to the central directory, through
the ZIP64 locator and record where sizes need them; its entries lead to the
stored members. Records are read by byte ranges: neighbouring records of the
index form one range of bounded size, ranges are spread over the executors,
and nothing is ever extracted. Packages without an index are scanned from the
archive's start.

Files are opened with ``pyarrow.fs`` from the folder's URI, so that any file
system it knows (local, HDFS, object stores) does.

Defined cases: a null payload is empty; a null id can't be the smallest
unless all are null; repeated rows with the smallest id and equal payloads
are all responses; a null URL has no target line, and line ends in a URL are
escaped.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm.frames import col, joinable, prepare, whole_text

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.json"
# Bytes of an archive before a task starts the next package, and of a range.
PACKAGE_BYTES = 256 * 1024 * 1024
BROADCAST_REPEATED = 100_000
RANGE_BYTES = 4 * 1024 * 1024
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ---------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record(record_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record: a response, or a revisit of record ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to is not None else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:record:{json.dumps(record_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = url.replace("\r", "%0D").replace("\n", "%0A")
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:record:{json.dumps(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse_record(raw: bytes) -> dict:
    """Fields of one record (see ``RECORD``)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    f = _fields(head)
    block = rest[: int(f["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    name = lambda v: json.loads(v.removeprefix("<urn:record:").removesuffix(">")) if v is not None else None
    digest = f.get("warc-payload-digest", "").removeprefix("sha1:")
    response = f["warc-type"] == "response"
    return {
        "record_id": name(f.get("warc-record-id")),
        "record_type": f["warc-type"],
        "url": f.get("warc-target-uri"),
        "payload_bytes": int(_fields(http).get("content-length", len(payload))),
        "payload_digest": digest,
        "refers_to": name(f.get("warc-refers-to")),
        "payload": payload if response else None,
        "digest_ok": payload_digest(payload) == digest if response else None,
    }


RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
        ("digest_ok", pa.bool_()),
    ]
)
RECORD_DDL = (
    "record_id string, record_type string, url string, payload_bytes long, payload_digest string, "
    "refers_to string, payload binary, digest_ok boolean"
)


# --- packages --------------------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Package:
    """Streams records into one new package."""

    def __init__(self, uri: str) -> None:
        self.uri = uri
        system, path = _open(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.places: list[tuple[int, int]] = []
        self.size = 0

    def add(self, raw: bytes) -> None:
        data = gzip.compress(raw, 6, mtime=0)
        self.member.write(data)
        self.places.append((self.size, len(data)))
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as out:
            for offset, length in self.places:
                out.write(json.dumps({"offset": offset, "length": length}).encode() + b"\n")
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.places), self.size


def write_packages(
    df: DataFrame, id_col: str, url_col: str, payload_col: str, folder: str, package_bytes: int = PACKAGE_BYTES
) -> DataFrame:
    """Writes a record per row of ``df`` into packages under ``folder`` (a URI
    that driver and executors share). Returns (package, n_records, n_bytes)."""
    prepare(df.sparkSession)
    rows = df.select(
        col(id_col).alias("id"), col(url_col).cast("string").alias("url"), whole_text(payload_col).alias("payload")
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    again = rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Up to BROADCAST_REPEATED payloads that repeat, the payloads stay where they are.
    placed = rows.join(joinable(again.checkpoint(), BROADCAST_REPEATED), "key", "left").select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"),
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package: Package | None = None
        done = []
        for batch in batches:
            for i in range(batch.num_rows):
                key, url, payload, refers = (c[i].as_py() for c in batch.columns)
                if package is None:
                    package = Package(f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zip")
                package.add(record(key, url, payload.encode(), refers))
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        if done:
            names = ["package", "n_records", "n_bytes"]
            yield pa.record_batch([pa.array(v) for v in zip(*done, strict=True)], names=names)

    return placed.mapInArrow(write, "package string, n_records long, n_bytes long").checkpoint()


# --- reading ---------------------------------------------------------------


def _at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """(first byte, length) of each stored member of an open ZIP file, from
    the central directory alone (and the members' local headers)."""
    tail = _at(file, max(0, size - 66_000), min(size, 66_000))
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("not a ZIP file: it has no end record")
    entries, _, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    length = struct.unpack("<I", tail[end + 12 : end + 16])[0]
    locator = tail[end - 20 : end] if end >= 20 else b""
    if locator.startswith(b"PK\x06\x07"):
        (where,) = struct.unpack("<Q", locator[8:16])
        wide = _at(file, where, 56)
        if not wide.startswith(b"PK\x06\x06"):
            raise ValueError("the ZIP64 end record is not where its locator says")
        entries, length, start = struct.unpack("<QQQ", wide[32:56])
    raw, at, members = _at(file, start, length), 0, {}
    for _ in range(entries):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, full = struct.unpack("<H", raw[at + 10 : at + 12])[0], *struct.unpack("<II", raw[at + 20 : at + 28])
        n_name, n_extra, n_comment = struct.unpack("<HHH", raw[at + 28 : at + 34])
        (header,) = struct.unpack("<I", raw[at + 42 : at + 46])
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:  # the ZIP64 field holds what doesn't fit above, in this order
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                values = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        at += 46 + n_name + n_extra + n_comment
        if method == zipfile.ZIP_STORED:
            local = _at(file, header, 30)
            n_name, n_extra = struct.unpack("<HH", local[26:30])
            members[name] = (header + 30 + n_name + n_extra, packed)
    return members


def _scan(file, start: int, length: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of each gzip member, by reading the archive through."""
    at, begin, unzip = 0, 0, zlib.decompressobj(31)
    while at < length:
        data = _at(file, start + at, min(1 << 20, length - at))
        at += len(data)
        while data:
            unzip.decompress(data)
            data = b""
            if unzip.eof:
                data = unzip.unused_data
                end = at - len(data)
                yield begin, end - begin
                begin, unzip = end, zlib.decompressobj(31)


def _index(file, members: dict[str, tuple[int, int]], archive: str) -> Iterator[tuple[int, int]]:
    if INDEX in members:
        for line in _at(file, *members[INDEX]).splitlines():
            entry = json.loads(line)
            yield entry["offset"], entry["length"]
    else:
        yield from _scan(file, *members[archive])


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(package) -> (package, first byte, lengths of neighbouring records)."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            system, path = _open(uri)
            rows: list[tuple[str, int, list[int]]] = []
            with system.open_input_file(path) as file:
                members = directory(file, file.size())
                for archive in [m for m in members if m.startswith("archive/") and m.endswith(".warc.gz")]:
                    start, size, lengths, upto = members[archive][0], 0, [], None
                    for offset, length in _index(file, members, archive):
                        if lengths and (offset != upto or size + length > RANGE_BYTES):
                            rows.append((uri, first, lengths))
                            lengths, size = [], 0
                        if not lengths:
                            first = start + offset
                        lengths.append(length)
                        size += length
                        upto = offset + length
                    if lengths:
                        rows.append((uri, first, lengths))
            if rows:
                yield pa.record_batch(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.int64())))],
                    names=["package", "first", "lengths"],
                )


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, first, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            system, path = _open(uri)
            with system.open_input_file(path) as file:
                raw = _at(file, first, sum(lengths))
            found, at = [], 0
            for length in lengths:
                found.append(parse_record(gzip.decompress(raw[at : at + length])))
                at += length
            yield pa.RecordBatch.from_pylist(found, schema=RECORD)


def read_packages(packages: DataFrame, parallel: int | None = None) -> DataFrame:
    """Records of all packages named in the column ``package``."""
    spark: SparkSession = packages.sparkSession
    prepare(spark)
    n = parallel or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = packages.select("package").mapInArrow(_ranges, "package string, first long, lengths array<long>")
    return ranges.repartition(n).mapInArrow(_read, RECORD_DDL)
