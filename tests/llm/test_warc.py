import base64
import hashlib
import io
import zipfile

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from ridecells.llm import warc
from ridecells.llm.warc import parse_record, read_archives, warc_record, write_archives, zip_members
from tests.llm.helpers import LONG

PAGES = "page_id bigint, url string, html string, refers_to string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None) if len(data) >= least else None
        refers = None if first == page_id else first
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


ROWS = [(5, "http://a", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "http://b\r\nX: y", "<p>öne 你 \U0001f600</p>"), (1, "u", None),
        (2, "u", ""), (7, "u", LONG), (8, "u", "a\r\n\r\nWARC/1.1\r\n\r\n"), (3, None, "<p>one</p>"), (None, "u", "<p>one</p>"), (None, "u", "alone")]


@pytest.mark.parametrize("least, size", [(0, 32_000_000), (0, 100), (11, 32_000_000)])
def test_records_come_back(spark, least, size):
    manifest, folder = write_archives(pages(spark, ROWS).repartition(3), None, least, size)
    found = read_archives(manifest, folder).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected(ROWS, least)
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == {(h or "").encode() for _, _, h in ROWS}
    assert all(r.payload is None for r in found if r.record_type == "revisit")


def test_many_tasks_read_back(spark):
    manifest, folder = write_archives(pages(spark, ROWS).repartition(3), archive_bytes=100)
    assert manifest.count() > 6
    assert read_archives(manifest, folder).select(F.spark_partition_id()).distinct().count() > 3


def test_archives_are_plain_zip_files(spark):
    manifest, folder = write_archives(pages(spark, ROWS).coalesce(1))
    store, top = fs.FileSystem.from_uri(folder)
    [row] = manifest.collect()
    with store.open_input_file(f"{top}/{row.file}") as file:
        whole = file.read()
    with zipfile.ZipFile(io.BytesIO(whole)) as archive:
        assert archive.testzip() is None
        assert archive.namelist() == [warc.DATA, warc.INDEX] and len(archive.read(warc.INDEX).split(b"\n")) == row.records == len(ROWS)


def members_of(data):
    return zip_members(lambda offset, length: data[offset:offset + length], len(data))


@pytest.mark.parametrize("limit", [1 << 31, 10])
def test_directories_with_and_without_zip64(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2 if limit == 10 else 65535)
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as archive:
        archive.writestr("a", b"12345678901234567890")
        archive.writestr("é/b", b"")
        archive.writestr("c", b"xyz")
        archive.comment = b"a comment"
    data = file.getvalue()
    assert (b"PK\x06\x06" in data) == (limit == 10)
    found = members_of(data)
    assert {k: (data[at:at + n], m) for k, (at, n, m) in found.items()} == {"a": (b"12345678901234567890", 0), "é/b": (b"", 0), "c": (b"xyz", 0)}


def test_broken_files_are_refused():
    for data in (b"", b"PK\x05\x06" + b"\xff" * 18, b"x" * 100):
        with pytest.raises(Exception):
            members_of(data)


def test_record_text():
    fields, block = parse_record(warc_record(4, "http://x", b"body", None))
    assert fields["warc-type"] == "response" and block.endswith(b"\r\n\r\nbody") and fields["warc-target-uri"] == "http://x"
    fields, block = parse_record(warc_record(4, "http://x", b"body", 2))
    assert fields["warc-refers-to"] == "<urn:page:2>" and b"body" not in block and b"Content-Length: 4" in block


def test_damage_is_noticed(spark):
    manifest, folder = write_archives(pages(spark, [(1, "u", "payload")]))
    store, top = fs.FileSystem.from_uri(folder)
    path = f"{top}/{manifest.first().file}"
    with store.open_input_file(path) as file:
        data = file.read()
    at = members_of(data)[warc.DATA][0]
    with store.open_output_stream(path) as file:
        file.write(data[:at + 30] + bytes([data[at + 30] ^ 255]) + data[at + 31:])
    with pytest.raises(Exception):
        read_archives(manifest, folder).collect()


def test_no_pages(spark):
    manifest, folder = write_archives(pages(spark, []))
    assert read_archives(manifest, folder).collect() == []
