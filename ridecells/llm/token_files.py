"""Token ids in binary files under a canonical Huffman code.

Documents are sorted by id over the cluster and encoded to ids once, into rows
of a few million ids (segments) in the shared folder. Counts of ids over all
segments, at most one number per id of the vocabulary, make one length-limited
code. Every segment becomes one file of independent blocks; a block's bit
offsets are kept at every ``SPACING`` ids, so that it is decoded from all of
these places at once, and so that a reader can start at any of them.

Layout of a file, all numbers little-endian: magic, six unsigned 64-bit numbers
(sizes of the code, of the documents and of the block table, then ids a block,
ids a checkpoint, ids in all); code lengths (zlib); document ids, a byte each
that tells a null, and ids per document (zlib); for each block its byte place,
bytes and ids, and its checkpoints (zlib); the blocks.

A file's name holds the task attempt that wrote it and only files named in the
manifest, a Parquet table, count. So a lost or repeated task leaves no trace in
what is read.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema, spread, stored
from ridecells.llm.huffman import code_lengths, codes_of, decode_block, decode_table, encode_block
from ridecells.llm.tokens import encoder
from ridecells.session import shared_folder

MAGIC = b"TOKHUF01"
SEGMENT_IDS = 4_000_000
BLOCK_IDS = 1 << 18
SPACING = 64

_SEGMENTS = "part int, nth int, n_docs bigint, n_ids bigint, doc_ids binary, ids binary"
_MANIFEST = "part int, nth int, file string, n_docs bigint, n_ids bigint, file_bytes bigint"


def segments(docs, tokenizer, end_id=1, segment_ids=SEGMENT_IDS):
    """Rows of up to ``segment_ids`` ids (or one document), in order of (part, nth)."""
    head = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")])

    def gather(batches):
        part, encode, end = TaskContext.get().partitionId(), encoder(tokenizer).ids, np.array([end_id], "<u4").tobytes()
        nth, size, docs_here, ids_here = 0, 0, [], []

        def row():
            ids = np.frombuffer(b"".join(ids_here), "<u4")
            return arrow_batch([(part, nth, len(docs_here), len(ids), np.array(docs_here, head).tobytes(),
                                 ids.astype("<u2" if narrow else "<u4").tobytes())], schema)

        narrow = encoder(tokenizer).library.get_vocab_size() <= 1 << 16 > end_id
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                if docs_here and size + len(ids) // 4 > segment_ids:
                    yield row()
                    nth, size, docs_here, ids_here = nth + 1, 0, [], []
                docs_here.append((doc_id or 0, doc_id is None, len(ids) // 4))
                ids_here.append(ids)
                size += len(ids) // 4
        if docs_here:
            yield row()

    schema = arrow_schema(_SEGMENTS)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(gather, _SEGMENTS)


def _ids(row):
    wide = len(row["ids"]) // max(1, row["n_ids"])
    return np.frombuffer(row["ids"], f"<u{wide or 4}")


def id_counts(rows):
    """How often each id occurs in the segments: (id, n)."""
    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = np.bincount(_ids(row))
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["id", "n"])

    return rows.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(rows, folder):
    """Write the segments as files below the folder; their manifest as a frame."""
    counted = id_counts(rows).collect()  # one row per id of the vocabulary at most
    counts = np.zeros(max([r["id"] for r in counted], default=-1) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    code = zlib.compress(lengths.tobytes())

    def write(batches):
        codes, own = codes_of(lengths), np.frombuffer(zlib.decompress(code), np.uint8)
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                ids, blocks, table, at = _ids(row), [], [], 0
                for start in range(0, len(ids), BLOCK_IDS):
                    here = ids[start:start + BLOCK_IDS]
                    packed, offsets = encode_block(here, codes, own, SPACING)
                    blocks.append(packed)
                    table += [np.array([at, len(packed), len(here)], "<u8"), offsets.astype("<u4").view("u1")]
                    at += len(packed)
                head, where = zlib.compress(row["doc_ids"], 1), zlib.compress(b"".join(t.tobytes() for t in table), 1)
                name = f"{row['part']:06d}-{row['nth']:06d}-{TaskContext.get().taskAttemptId()}.tok"
                parts = [MAGIC, struct.pack("<6Q", len(code), len(head), len(where), BLOCK_IDS, SPACING, len(ids)), code, head, where, *blocks]
                with store.open_output_stream(f"{top}/{name}") as file:
                    for part in parts:
                        file.write(part)
                yield arrow_batch([(row["part"], row["nth"], name, row["n_docs"], row["n_ids"], sum(map(len, parts)))], schema)

    schema = arrow_schema(_MANIFEST)
    return stored(rows.mapInArrow(write, _MANIFEST), "token-manifest")


def read_file(store, path):
    """(doc_id, ids) of each document of a file, block after block."""
    with store.open_input_file(path) as file:
        if file.read(8) != MAGIC:
            raise ValueError(f"{path} is no token file")
        code, head, where, block_ids, spacing, n_ids = struct.unpack("<6Q", file.read(48))
        lengths = np.frombuffer(zlib.decompress(file.read(code)), np.uint8)
        docs = np.frombuffer(zlib.decompress(file.read(head)), np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")]))
        places, base = zlib.decompress(file.read(where)), 56 + code + head + where
        table, at, rest, doc = decode_table(lengths), 0, np.zeros(0, np.uint32), 0
        for start in range(0, n_ids, block_ids):
            place, size, count = np.frombuffer(places, "<u8", 3, at)
            marks = -(-int(count) // spacing)
            offsets = np.frombuffer(places, "<u4", marks, at + 24)
            at += 24 + 4 * marks
            file.seek(base + int(place))
            rest = np.concatenate([rest, decode_block(file.read(int(size)), offsets, int(count), table, spacing)])
            used = 0
            while doc < len(docs) and used + docs["n"][doc] <= len(rest):
                n = int(docs["n"][doc])
                yield None if docs["null"][doc] else int(docs["doc_id"][doc]), rest[used:used + n]
                used, doc = used + n, doc + 1
            rest = rest[used:]


def read_files(manifest, folder, with_ids=True):
    """Documents of the files: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids.

    ``start`` counts the ids of all documents before it. The files' own starts
    are running sums over the manifest, per part first.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task that wrote
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.join(parts, "part").select(
        "file", (F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start"))

    def read(batches):
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["start"], []
                for doc_id, ids in read_file(store, f"{top}/{row['file']}"):
                    packed = ids.astype("<u4").tobytes()
                    out.append((doc_id, start, len(ids), zlib.crc32(packed), *([packed] if with_ids else [])))
                    start += len(ids)
                    if len(out) >= 1000:
                        yield arrow_batch(out, schema)
                        out = []
                if out:
                    yield arrow_batch(out, schema)

    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    schema = arrow_schema(columns)
    return spread(files, manifest.count()).mapInArrow(read, columns)


def write_documents(docs, tokenizer, end_id=1, folder=None):
    """(manifest, folder) of the files of all documents, in ascending order of id.

    Reads ``doc_id`` and ``text`` only. Null and empty texts have the end id
    alone. Null ids come first; rows with one id are in order of their texts. No
    documents make no files.
    """
    folder = folder or shared_folder(docs.sparkSession, "token-files")
    return write_files(stored(segments(docs, tokenizer, end_id), "segments"), folder), folder
