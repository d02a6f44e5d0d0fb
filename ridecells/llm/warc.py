"""WARC records in ZIP archives: written by tasks, read back by byte ranges.

Every page becomes a WARC record with an HTTP response as its block. Of pages
with equal payloads the one with the smallest id is a response, the others are
revisits that refer to it; revisits keep the HTTP head, so the payload's size
and digest can be read from either. A task writes archives of about
``ARCHIVE_BYTES``: ZIP files with two stored members, ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdxj`` (id, place and size of
each record).

The reader never extracts a member. It finds the end of the central directory,
by the ZIP64 records where sizes or counts ask for them, takes the places of
members from the directory and their local heads, reads the index, and then
only the byte range of each record.

Archives are named by the task attempt that wrote them, and only those in the
manifest count, so lost or repeated tasks leave no trace in what is read.
"""

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile
import zlib

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema, spread, stored
from ridecells.session import shared_folder

ARCHIVE_BYTES = 32_000_000
#: Records that a reader's row covers.
RANGE_RECORDS = 256
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "2026-01-01T00:00:00Z"


def digest(payload):
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(text):
    """A value without line breaks; nothing for null."""
    return " ".join((text or "").split())


def warc_record(page_id, url, payload, refers_to):
    """The bytes of one record; a revisit, without payload, if it refers to another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
             f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data):
    """(head as a dict with names in lower case, block) of a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def page_of(fields, block):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of a parsed record."""
    def number(name):
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    head, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.partition(":")[2] for line in head.decode().split("\r\n") if line.lower().startswith("content-length:")]
    kind = fields["warc-type"]
    return (number("warc-record-id"), int(sizes[0]), fields["warc-payload-digest"].removeprefix("sha1:"), kind,
            number("warc-refers-to"), payload if kind == "response" else None)


def first_of_payloads(pages, least_bytes=0):
    """The pages with ``refers_to``: the smallest id with an equal payload, null for that one itself.

    Payloads under ``least_bytes`` and rows with a null id never refer to one of
    their own; rows with a null id refer to another if there is one.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha1"))
    firsts = keyed.where(F.octet_length("html") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"))
    refers = F.when(F.col("first") == F.col("page_id"), None).otherwise(F.col("first"))
    return keyed.join(stored(firsts, "payloads"), "sha1", "left").select("page_id", "url", "html", refers.alias("refers_to"))


class _Archive:
    """A ZIP file under way: records go to its data member, then the index follows."""

    def __init__(self, store, path):
        self.path, self.lines, self.at = path, [], 0
        self.file = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Forward(self.file), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, page_id, record):
        packed = gzip.compress(record, 6, mtime=0)
        self.member.write(packed)
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.at, "length": len(packed)}))
        self.at += len(packed)

    def close(self):
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        self.file.close()
        return len(self.lines)


class _Forward(io.RawIOBase):
    """A stream that can only be written onward, for zipfile."""

    def __init__(self, file):
        self.file = file

    def writable(self):
        return True

    def write(self, data):
        self.file.write(data)
        return len(data)

    def flush(self):
        pass


_MANIFEST = "file string, records bigint"


def write_archives(pages, folder=None, least_bytes=0, archive_bytes=ARCHIVE_BYTES):
    """(manifest, folder) of ZIP archives with a record for every page row.

    Reads ``page_id``, ``url`` and ``html``. A null html is an empty payload, a
    null url an empty header. Repeated rows give repeated records. No pages
    make no archives.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def write(batches):
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        open_archive, made = None, 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if open_archive is None:
                    name = f"{TaskContext.get().taskAttemptId()}-{made}.wacz"
                    open_archive, made = _Archive(store, f"{top}/{name}"), made + 1
                open_archive.add(page_id, warc_record(page_id, url, html.encode(), refers_to))
                if open_archive.at >= archive_bytes:
                    yield arrow_batch([(name, open_archive.close())], schema)
                    open_archive = None
        if open_archive is not None:
            yield arrow_batch([(name, open_archive.close())], schema)

    schema = arrow_schema(_MANIFEST)
    return stored(first_of_payloads(pages, least_bytes).mapInArrow(write, _MANIFEST), "warc-manifest"), folder


def zip_members(read, size):
    """Name to (place of the data, bytes, method) of a ZIP file's members.

    ``read(offset, length)`` gives bytes; only directories and local heads are
    read. Sizes, places and counts that don't fit their fields are taken from
    the ZIP64 records.
    """
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, directory_size, directory_at = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (directory_size, directory_at):
        signature, place = struct.unpack_from("<4s4xQ", tail, end - 20)
        if signature != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = read(place, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, directory_size, directory_at = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = read(directory_at, directory_size), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, unpacked, n_name, n_extra, n_comment, place = struct.unpack_from("<10xH8xIIHHH8xI", directory, at)
        name = directory[at + 46:at + 46 + n_name].decode()
        packed, place = _wide(directory[at + 46 + n_name:at + 46 + n_name + n_extra], unpacked, packed, place)
        local = read(place, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("broken local head")
        members[name] = (place + 30 + sum(struct.unpack_from("<HH", local, 26)), packed, method)
        at += 46 + n_name + n_extra + n_comment
    return members


def _wide(extra, unpacked, packed, place):
    """Packed size and place, from the ZIP64 field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if unpacked == 0xFFFFFFFF:
                wide.pop(0)
            packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
            place = wide.pop(0) if place == 0xFFFFFFFF else place
        at += 4 + length
    return packed, place


def _reader(store, path):
    file = store.open_input_file(path)
    return file, lambda offset, length: file.read_at(length, offset)


def record_ranges(manifest, folder, records=RANGE_RECORDS):
    """Rows (file, offsets, lengths): absolute byte ranges of some records of an archive each."""
    layout = "file string, offsets array<bigint>, lengths array<bigint>"

    def locate(batches):
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                file, read = _reader(store, f"{top}/{name}")
                with file:
                    members = zip_members(read, file.size())
                    (data, size, method), (index, index_size, index_method) = members[DATA], members[INDEX]
                    if method or index_method:
                        raise ValueError(f"members of {name} aren't stored")
                    entries = [json.loads(line) for line in read(index, index_size).decode().split("\n")]
                if any(e["offset"] + e["length"] > size for e in entries):
                    raise ValueError(f"the index of {name} points beyond its data")
                for at in range(0, len(entries), records):
                    part = entries[at:at + records]
                    yield arrow_batch([(name, [data + e["offset"] for e in part], [e["length"] for e in part])], schema)

    schema = arrow_schema(layout)
    return spread(manifest.select("file"), manifest.count()).mapInArrow(locate, layout)


def read_archives(manifest, folder, with_payload=True):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of every record.

    Size and digest are those of the whole payload, also for revisits; a
    response whose payload doesn't have its digest is refused. ``payload`` is
    null for revisits, and comes only if wanted.
    """
    layout = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + (
        ", payload binary" if with_payload else "")

    def fetch(batches):
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                file, read = _reader(store, f"{top}/{row['file']}")
                out = []
                with file:
                    for offset, length in zip(row["offsets"], row["lengths"]):
                        page = page_of(*parse_record(zlib.decompress(read(offset, length), 31)))
                        if page[5] is not None and (len(page[5]), digest(page[5])) != page[1:3]:
                            raise ValueError(f"a record of {row['file']} is damaged")
                        out.append(page if with_payload else page[:5])
                yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    ranges = stored(record_ranges(manifest, folder), "warc-ranges")
    return spread(ranges, ranges.count()).mapInArrow(fetch, layout)
