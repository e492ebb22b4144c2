"""WARC records in ZIP packages: written by tasks, located by the ZIP directories, read by ranges.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, a gzip member per record, and
``indexes/index.cdxj``, a line per record with its offset and length in the first. Reading parses the end records
(ZIP64 too), the central directory and the local headers for where a stored member's bytes lie, reads the index, and
takes each record by its range of the package. Nothing is extracted.

Of records with equal payloads of ``REVISIT_BYTES`` or more, that with the largest id is a response; the others are
revisits that refer to it. Payloads meet by their digest in an aggregation, so a payload on a third of all
pages is one row per task, and pages are joined by id with the few columns that come of it.

A task may be repeated: each attempt writes packages of its own name, and only those that a finished task reports are
read. Packages hold about ``PACKAGE_BYTES``, so a task's memory is bounded.

Defined cases: a null payload is empty; a null url has no target header; a row without id is a response and never
referred to; rows that repeat both id and payload get the same type; an empty table gives no package and an empty
result; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import stage, staging_path

from . import files
from .arrays import slices

REVISIT_BYTES = 1_000
PACKAGE_BYTES = 32 << 20
# Ranges of a package that lie together are read at once up to so many bytes.
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def typed(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, size, refers_to) per row; refers_to is null for responses."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html).alias("digest"), F.length(html).cast("long").alias("size"))
    named = rows.where((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    responses = named.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to").drop("least")
    revisits = named.join(responses, "digest").where("page_id < refers_to").distinct()
    return rows.join(revisits, ["page_id", "digest"], "left")


def record(page_id, url, html: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, uncompressed. A revisit has the headers of the response only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    block = http + html if refers_to is None else http
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Payload-Length: {len(html)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record; digests are verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda field: int(text) if (text := fields[field][len("<urn:page:") : -1]) else None
    if fields["WARC-Type"] == "revisit":
        return number("WARC-Record-ID"), int(fields["X-Payload-Length"]), digest, "revisit", number("WARC-Refers-To")
    payload = block.partition(b"\r\n\r\n")[2]
    if (own := hashlib.sha1(payload).hexdigest()) != digest:
        raise ValueError(f"payload digest {own}, header {digest}")
    return number("WARC-Record-ID"), len(payload), digest, "response", None


def package(records: list[tuple[int | None, bytes]]) -> bytes:
    """ZIP file of the records and their index."""
    data, index = io.BytesIO(), []
    for page_id, raw in records:
        packed = gzip.compress(raw, 6, mtime=0)
        index.append(json.dumps({"page": page_id, "offset": data.tell(), "length": len(packed)}))
        data.write(packed)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for name, content in ((DATA, data.getbuffer()), (INDEX, "\n".join(index).encode())):
            with archive.open(zipfile.ZipInfo(name), "w") as member:
                member.write(content)
    return out.getvalue()


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes packages below ``folder``; a row (path, records) for each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, attempt = [], 0, uuid.uuid4().hex

        def flushed(number: int) -> pa.RecordBatch:
            path = f"{folder}/{attempt}-{number}.zip"
            files.write(path, package(held))
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([len(held)], pa.int64())})

        number = 0
        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                html = (row["html"] or "").encode()
                raw = record(row["page_id"], row["url"], html, row["digest"], row["refers_to"])
                held.append((row["page_id"], raw))
                size += len(raw)
                if size >= PACKAGE_BYTES:
                    yield flushed(number)
                    held, size, number = [], 0, number + 1
        if held:
            yield flushed(number)

    return stage(typed(pages).mapInArrow(task, "path string, records long"), "packages")


def members(file) -> dict[str, tuple[int, int]]:
    """Where the bytes of each stored member of a ZIP file lie: name to (start, length)."""

    def at(start: int, length: int) -> bytes:
        file.seek(start)
        return file.read(length)

    file.seek(0, 2)
    size = file.tell()
    # The end record is last but for a comment of at most 65,535 bytes.
    tail_start = max(0, size - 22 - 65_535)
    tail = at(tail_start, size - tail_start)
    end = tail.rfind(b"PK\5\6")
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    entries, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = tail[end - 20 : end]
        if locator[:4] != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        record64 = at(struct.unpack("<Q", locator[8:16])[0], 56)
        if record64[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end record")
        entries, length, start = struct.unpack("<QQQ", record64[32:56])
    directory, cursor, found = at(start, length), 0, {}
    for _ in range(entries):
        if directory[cursor : cursor + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", directory[cursor + 10 : cursor + 12])
        packed, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", directory[cursor + 20 : cursor + 34])
        header, = struct.unpack("<I", directory[cursor + 42 : cursor + 46])
        name = directory[cursor + 46 : cursor + 46 + n_name].decode()
        extra = directory[cursor + 46 + n_name : cursor + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                # Only values that do not fit the entry are here, in this order.
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        if method != 0:
            raise ValueError(f"member {name} is not stored")
        local = at(header, 30)
        if local[:4] != b"PK\3\4":
            raise ValueError(f"no local header of {name}")
        found[name] = header + 30 + sum(struct.unpack("<HH", local[26:30])), packed
        cursor += 46 + n_name + n_extra + n_comment
    return found


def ranges(file) -> list[tuple[int, int]]:
    """Start and length in the package of every record, by its index."""
    found = members(file)
    file.seek(found[INDEX][0])
    lines = file.read(found[INDEX][1]).decode().splitlines()
    base = found[DATA][0]
    return [(base + entry["offset"], entry["length"]) for entry in map(json.loads, lines)]


def records(file, wanted: list[tuple[int, int]]) -> Iterator[bytes]:
    """Records at some ranges, uncompressed; neighbours come with one read."""
    at = 0
    while at < len(wanted):
        stop, first = at + 1, wanted[at][0]
        while stop < len(wanted) and wanted[stop][0] == sum(wanted[stop - 1]) and sum(wanted[stop]) - first <= READ_BYTES:
            stop += 1
        file.seek(first)
        chunk = file.read(sum(wanted[stop - 1]) - first)
        for start, length in wanted[at:stop]:
            yield gzip.decompress(chunk[start - first : start - first + length])
        at = stop


def read(packages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of packages (path)."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = files.located(path)
                with system.open_input_file(inner) as file:
                    rows = []
                    for raw in records(file, ranges(file)):
                        rows.append(parsed(raw))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packages.select("path").repartition(parts).mapInArrow(
        task, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Every page through a package and back."""
    return read(write(pages, staging_path(spark, "warc")))
