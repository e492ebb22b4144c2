import hashlib
import io
import zipfile

import pytest

from tidegrid.llm import warc
from tidegrid.session import staging_path


def brute(rows):
    out, last = [], {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if i is not None and len(raw) >= 1000:
            last[raw] = max(i, last.get(raw, i))
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = i is not None and last.get(raw, i) > i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last[raw] if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/", "x" * 1000), (2, None, "x" * 1000), (9, "http://b/\r\nX: y", "x" * 1000), (3, "http://é/", None), (4, "", ""), (5, "u", "é" * 499),
    (6, "u", "é" * 500), (7, "u", "é" * 500), (None, "u", "x" * 1000), (2, "u", "x" * 1000), (7, "u", "é" * 500), (7, "u", "other"), (8, "u", "WARC/1.1\r\n\r\n" * 200_000),
]


def test_round_trip(spark, monkeypatch):
    pages = spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, digest string").repartition(3)
    got = warc.round_trip(spark, pages)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_packages_are_plain_zip_files(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    packages = warc.write(pages, staging_path(spark, "warc")).collect()
    assert sum(p.records for p in packages) == len(ROWS)
    for p in packages:
        with zipfile.ZipFile(p.path.removeprefix("file:")) as archive:
            assert archive.testzip() is None and archive.namelist() == [warc.DATA, warc.INDEX]


@pytest.mark.parametrize("limit", [None, 20])
def test_zip64_directories(monkeypatch, limit):
    """With a limit of 20 bytes every size, offset and count of the package is in ZIP64 fields."""
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = [warc.record(i, "u", b"page %d" % i, hashlib.sha1(b"page %d" % i).hexdigest(), None) for i in range(50)]
    out = io.BytesIO()
    records, index, at = [], [], 0
    import gzip
    import json

    for i, r in enumerate(raw):
        packed = gzip.compress(r)
        index.append(json.dumps({"page": i, "offset": at, "length": len(packed)}))
        at += len(packed)
        records.append(packed)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("readme.txt", "x" * 40)
        with archive.open(warc.DATA, "w", force_zip64=bool(limit)) as member:
            member.write(b"".join(records))
        archive.writestr(warc.INDEX, "\n".join(index))
        archive.comment = b"with a comment"
    content = out.getvalue()
    assert (b"PK\6\6" in content) == bool(limit)
    file = io.BytesIO(content)
    assert list(warc.records(file, warc.ranges(file))) == raw
    assert list(warc.records(file, warc.ranges(file)[7:8])) == raw[7:8]


def test_damage_is_found():
    raw = warc.record(1, "u", b"page", hashlib.sha1(b"else").hexdigest(), None)
    with pytest.raises(ValueError):
        warc.parsed(raw)
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"not a zip file"))


def test_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    got = warc.round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
