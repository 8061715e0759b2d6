"""Legacy archives: ARC files are parsed and rewritten as WARC files.

An ARC record is a header line with space-separated fields, the last of which is the length of the body that follows.
Version 1 has five fields (URL, IP address, date, type, length), version 2 ten (result code, checksum, location, offset and
file name in between); the version stands in the version block at the start of a file. URLs of old archives may hold spaces,
so fields are counted from the right. Bodies are taken by their declared length, never by searching.

``convert`` parses archives and synthesises what WARC needs: a record id (UUID of archive name and offset, the same on
every run), an ISO timestamp, a type, digests of payload and block. Of records with equal payloads of at least
``LEAST_REVISIT`` bytes, the one with the smallest key is the response, the others become revisits of it without
payload; smaller payloads are always responses. Only digests and keys are grouped (a hot payload shrinks to a row per task), the
join back is one whose skewed partitions adaptive execution splits.

Files are written and read by Spark, so any store will do. A task begins a new archive when one has ``ARCHIVE_BYTES`` or more (before
it is packed), so a file holds that and one record at most, whatever the task's share of the rows; files are read one at a time,
record by record. Only an archive made elsewhere can be too large: packed, it must fit the 2 GB of one binary value. Null URLs are written as ``unknown:``, white space in URLs is
percent-encoded, null pages are empty payloads, null keys come after all others. Only the columns for key, URL and page are read,
whatever others are called. Repeated rows get a record each; of records with the same key the first by record id is the response. An empty
table gives archives without records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchlytics.llm.common import bound_batches, stored
from watchlytics.session import new_folder

LEAST_REVISIT = 100
#: Capture time written for pages, which have none of their own.
CAPTURED = "20240101000000"
#: Bytes, not packed, after which a task begins its next archive, and the rows such an archive is written in.
ARCHIVE_BYTES = 256 << 20
SEGMENTS = 32
#: Rows handed over at a time.
ROWS_AT_ONCE = 500
BYTES_AT_ONCE = 8 << 20
#: Fixed values of the formats.
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:watchlytics:arc")
KEY = b"x-record-key"
#: Version line and field list, by which a version block is told from a page whose URL begins like that of one.
VERSION_BODY = re.compile(rb"[0-9]+ [^\n]*\nURL IP-address Archive-date ")
END = "\r\n\r\n"


def clean_url(url: str | None) -> str:
    """URL without white space and control characters, which would end its field."""
    if not url:
        return "unknown:"
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def iso_time(stamp: str, other: str = "1970-01-01T00:00:00Z") -> str:
    """``YYYYMMDDhhmmss``, or the beginning of it, as a WARC timestamp."""
    digits = stamp[:14]
    if not digits.isdecimal() or len(digits) < 4:
        return other
    whole = digits + "00000101000000"[len(digits) :]
    year, month, day, hour, minute, second = whole[:4], *(whole[i : i + 2] for i in range(4, 14, 2))
    if not ("01" <= month <= "12" and "01" <= day <= "31" and hour < "24" and minute < "60" and second < "61"):
        return other
    return f"{year}-{month}-{day}T{hour}:{minute}:{second}Z"


def version_block(name: str, version: str, stamp: str) -> bytes:
    """First record of an archive."""
    body = f"{version} 0 watchlytics\n{FIELDS[version]}\n".encode()
    return arc_header(f"filedesc://{name}", "0.0.0.0", stamp, "text/plain", len(body), version) + body


def arc_header(url: str, ip: str, stamp: str, kind: str, length: int, version: str, code: int = 200, offset: int = 0, name: str = "-") -> bytes:
    if version == "1":
        return f"{url} {ip} {stamp} {kind} {length}\n".encode()
    return f"{url} {ip} {stamp} {kind} {code} - - {offset} {name} {length}\n".encode()


def http_response(payload: bytes, key: int | None) -> bytes:
    named = b"" if key is None else b"X-Record-Key: %d\r\n" % key
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n" + named + b"Content-Length: %d\r\n\r\n" % len(payload) + payload


@dataclass
class Record:
    """A record of an archive of either kind."""

    offset: int
    headers: dict[str, str]
    block: bytes


def opened(content: bytes):
    """The content as a stream, unpacked if it is packed (one or many gzip members)."""
    stream = io.BytesIO(content)
    return gzip.GzipFile(fileobj=stream) if content[:2] == b"\x1f\x8b" else stream


def arc_records(content: bytes) -> Iterator[Record]:
    """Records of an ARC file, the version block excluded."""
    stream, offset, version, first = opened(content), 0, "1", True
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        last = text.rpartition(" ")[2]  # the length, in both versions
        if not last.isdecimal():
            raise ValueError(f"no ARC header line at byte {start}: {text[:200]!r}")
        length = int(last)
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"the record at byte {start} ends {length - len(block)} bytes early")
        offset += length
        opening = text.startswith("filedesc://") and (first or VERSION_BODY.match(block) is not None)
        first = False
        names = FIELDS[("2" if text.count(" ") >= 9 else "1") if opening else version].split(" ")
        fields = text.rsplit(" ", len(names) - 1)
        if len(fields) != len(names):
            raise ValueError(f"no ARC header line at byte {start}: {text[:200]!r}")
        if opening:
            version = block.split(b" ", 1)[0].decode("ascii", "replace").strip()
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version!r}")
        else:
            yield Record(start, dict(zip(names, fields)), block)


def warc_records(content: bytes) -> Iterator[Record]:
    """Records of a WARC file, by their declared lengths."""
    stream, offset = opened(content), 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {start}: {line[:200]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            offset += len(line)
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        offset += len(line)
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"the record at byte {start} ends {length - len(block)} bytes early")
        offset += length
        yield Record(start, headers, block)


def split_http(block: bytes) -> tuple[bytes, bytes, dict[bytes, bytes]]:
    """Head with its empty line, payload and headers of an HTTP response; no head if it is none."""
    if not block.startswith(b"HTTP/"):
        return b"", block, {}
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return block, b"", {}
    pairs = (line.partition(b":") for line in block[:end].split(b"\r\n")[1:])
    return block[: end + 4], block[end + 4 :], {name.strip().lower(): value.strip() for name, _, value in pairs}


@dataclass
class _Rows:
    """Columns filled row by row, handed over when there are enough."""

    schema: pa.Schema
    columns: list[list] = field(default_factory=list)
    size: int = 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        if not self.columns:
            self.columns = [[] for _ in row]
        for column, value in zip(self.columns, row):
            column.append(value)
        self.size += size
        if self.size >= BYTES_AT_ONCE or len(self.columns[0]) >= ROWS_AT_ONCE:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.columns, self.schema.types)], schema=self.schema)
        self.columns, self.size = [], 0


class _Archives:
    """The archives of one task, one after the other, as rows: every ``SEGMENTS`` rows make an archive.

    A row joins records until it has its share of ``most`` bytes. The last rows of an archive that is full before may be
    empty; they become empty lines, which end records in both formats.
    """

    def __init__(self, separator: str, most: int):
        self.separator, self.most = separator.encode(), most
        self.number, self.offset, self.written = -1, 0, 0
        self.parts: list[bytes] = []
        self.held = 0
        self.rows = _Rows(RECORD)

    def full(self) -> bool:
        """Whether the next record belongs to a new archive, which ``begin`` must open."""
        return self.number < 0 or self.offset >= self.most

    def begin(self) -> Iterator[pa.RecordBatch]:
        if self.number >= 0:
            yield from self._row()
            while self.written < SEGMENTS:
                yield from self._row(empty=True)
        self.number, self.offset, self.written = self.number + 1, 0, 0

    def add(self, record: bytes) -> Iterator[pa.RecordBatch]:
        self.parts.append(record)
        self.held += len(record)
        self.offset += len(record) + len(self.separator)
        if self.held * SEGMENTS >= self.most:
            yield from self._row()

    def _row(self, empty: bool = False) -> Iterator[pa.RecordBatch]:
        if self.parts or empty:
            joined = self.separator.join(self.parts)
            self.parts, self.held = [], 0
            self.written += 1
            yield from self.rows.add((joined,), len(joined))

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self._row()
        yield from self.rows.rest()


def _write(records: DataFrame, path: str, separator: str) -> None:
    """Packed files of ``SEGMENTS`` rows; each binary ``record`` is followed by the separator."""
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("lineSep", separator)
        .option("maxRecordsPerFile", SEGMENTS)
        .text(path)
    )


RECORD = pa.schema([("record", pa.binary())])


def write_arc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", stamp: str = CAPTURED, most: int = ARCHIVE_BYTES
) -> None:
    """One ARC record per row, in the version 1 or 2 by turns of the files."""
    bound_batches(pages.sparkSession)
    given = pages.select(F.col(f"`{key}`").cast("long"), F.col(f"`{url}`"), F.col(f"`{html}`").cast("binary"), F.spark_partition_id())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, version, name = _Archives("\n", most), "", ""
        for batch in batches:
            for number, address, body, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                if out.full():
                    yield from out.begin()
                    version, name = "12"[(part + out.number) % 2], f"pages-{part:05d}-{out.number:05d}.arc.gz"
                    yield from out.add(version_block(name, version, stamp))
                block = http_response(body.as_py() or b"", number)
                yield from out.add(arc_header(clean_url(address), "0.0.0.0", stamp, "text/html", len(block), version, 200, out.offset, name) + block)
        yield from out.rest()

    _write(given.mapInArrow(make, "record binary"), path, "\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    # Batches are bounded by bytes, so a large file is a batch of its own.
    return spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("path", "content")


PARSED = pa.schema(
    [
        ("record_id", pa.string()),
        ("url", pa.string()),
        ("ip", pa.string()),
        ("captured", pa.string()),
        ("key", pa.int64()),
        ("head", pa.binary()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)
PARSED_DDL = "record_id string, url string, ip string, captured string, key long, head binary, payload binary, payload_bytes long, payload_digest string"


def read_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all ARC files below ``path``, with what WARC needs."""
    bound_batches(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(PARSED)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = name.rpartition("/")[2]
                for record in arc_records(content.as_py()):
                    head, payload, http = split_http(record.block)
                    number = http.get(KEY, b"")
                    row = (
                        f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{name}:{record.offset}')}",
                        record.headers["URL"],
                        record.headers["IP-address"],
                        iso_time(record.headers["Archive-date"]),
                        int(number) if number.lstrip(b"-").isdigit() else None,
                        head if with_payload else b"",
                        payload if with_payload else b"",
                        len(payload),
                        hashlib.sha256(payload).hexdigest(),
                    )
                    yield from rows.add(row, len(record.block) if with_payload else 0)
        yield from rows.rest()

    return _files(spark, path).mapInArrow(parse, PARSED_DDL)


def warc_header(kind: str, fields: list[tuple[str, str | None]], length: int, content_type: str) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{a}: {b}" for a, b in fields if b is not None)]
    return "\r\n".join([*lines, f"Content-Type: {content_type}", f"Content-Length: {length}", "", ""]).encode()


def write_warc(records: DataFrame, path: str, most: int = ARCHIVE_BYTES) -> None:
    """Write parsed records; those with ``refers_to`` (record id) become revisits without payload."""
    bound_batches(records.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archives(END, most)
        for batch in batches:
            for r in batch.to_pylist():
                if out.full():
                    yield from out.begin()
                    body = b"software: watchlytics\r\nformat: WARC File Format 1.1\r\n"
                    about = f"urn:uuid:{uuid.uuid5(NAMESPACE, 'about ' + r['record_id'])}"
                    head = warc_header("warcinfo", [("WARC-Record-ID", f"<{about}>"), ("WARC-Date", r["captured"])], len(body), "application/warc-fields")
                    yield from out.add(head + body)
                again = r["refers_to"] is not None
                block = r["head"] if again else r["head"] + r["payload"]
                fields = [
                    ("WARC-Record-ID", f"<{r['record_id']}>"),
                    ("WARC-Target-URI", r["url"]),
                    ("WARC-Date", r["captured"]),
                    ("WARC-IP-Address", r["ip"]),
                    ("WARC-Payload-Digest", "sha256:" + r["payload_digest"]),
                    ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
                    ("WARC-Refers-To", f"<{r['refers_to']}>" if again else None),
                    ("WARC-Profile", REVISIT_PROFILE if again else None),
                ]
                kind = "application/http; msgtype=response" if r["head"] else "application/octet-stream"
                record = warc_header("revisit" if again else "response", fields, len(block), kind) + block
                yield from out.add(record)
        yield from out.rest()

    _write(records.mapInArrow(make, "record binary"), path, END)


def convert(spark: SparkSession, arc: str, warc: str, least: int = LEAST_REVISIT, most: int = ARCHIVE_BYTES) -> None:
    """Rewrite all ARC files below ``arc`` as WARC files in the folder ``warc``."""
    rank = F.struct(F.col("key").isNull().alias("nameless"), F.col("key"), F.col("record_id"))
    small = read_arc(spark, arc, with_payload=False).where(F.col("payload_bytes") >= least)
    groups = small.groupBy("payload_digest").agg(F.min(rank).alias("best"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1").select("payload_digest", F.col("best.record_id").alias("response")), "warc-responses")
    records = read_arc(spark, arc).join(groups, "payload_digest", "left")
    # A revisit tells the payload's length in its HTTP head; a record without one stays a response.
    again = (F.col("payload_bytes") >= least) & (F.col("response") != F.col("record_id")) & (F.length("head") > 0)
    records = records.withColumn("refers_to", F.when(again, F.col("response")))
    columns = [f.name for f in PARSED]
    write_warc(records.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload"))).select(*columns, "refers_to"), warc, most)


READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("url", pa.string()),
        ("captured", pa.string()),
        ("record_type", pa.string()),
        ("key", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to_record", pa.string()),
    ]
)
READ_DDL = "record_id string, url string, captured string, record_type string, key long, payload_bytes long, payload_digest string, refers_to_record string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All response and revisit records below ``path``. Payload digests of responses and block digests of all are checked."""
    bound_batches(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(READ)
        for batch in batches:
            for content in batch.column(1):
                for record in warc_records(content.as_py()):
                    own = record.headers
                    if own["warc-type"] == "warcinfo":
                        continue
                    head, payload, http = split_http(record.block)
                    declared = own["warc-payload-digest"].removeprefix("sha256:")
                    again = own["warc-type"] == "revisit"
                    if "sha256:" + hashlib.sha256(record.block).hexdigest() != own["warc-block-digest"]:
                        raise ValueError(f"block digest of {own['warc-record-id']} does not hold")
                    if not again and hashlib.sha256(payload).hexdigest() != declared:
                        raise ValueError(f"payload digest of {own['warc-record-id']} does not hold")
                    number = http.get(KEY, b"")
                    length = int(http.get(b"content-length", b"0")) if again else len(payload)
                    row = (
                        own["warc-record-id"].strip("<>"),
                        own["warc-target-uri"],
                        own["warc-date"],
                        own["warc-type"],
                        int(number) if number.lstrip(b"-").isdigit() else None,
                        length,
                        declared,
                        own["warc-refers-to"].strip("<>") if again else None,
                    )
                    yield from rows.add(row, 0)
        yield from rows.rest()

    return _files(spark, path).mapInArrow(parse, READ_DDL)


def round_trip(pages: DataFrame, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages as ARC, convert to WARC, read that back: key, payload bytes and digest, type, key of the response."""
    spark = pages.sparkSession
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(pages, arc, most=most)
    convert(spark, arc, warc, most=most)
    found = stored(read_warc(spark, warc), "warc-records")
    wanted = found.where("refers_to_record IS NOT NULL").select(F.col("refers_to_record").alias("response_record")).distinct()
    responses = found.join(wanted, F.col("record_id") == F.col("response_record"), "left_semi")
    # Written, so that the join shuffles both sides and a response with very many revisits can be split.
    responses = stored(responses.select(F.col("record_id").alias("response_record"), F.col("key").alias("refers_to")), "warc-responses")
    return found.join(responses, F.col("refers_to_record") == F.col("response_record"), "left").drop("response_record", "refers_to_record")
