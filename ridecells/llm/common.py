"""Helpers shared by the operators of this folder."""

import pyarrow as pa
from pyspark.sql import functions as F

from ridecells.session import shared_folder


def stored(frame, name):
    """The frame, written once to the shared folder and read back.

    Later readers see one fixed set of rows, whichever executors are lost.
    """
    path = shared_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Tasks at most for rows that each stand for much more than their own bytes.
_MOST_TASKS = 10_000


def spread(frame, rows):
    """The frame, of so many rows, dealt evenly to as many tasks, ``_MOST_TASKS`` at most.

    The number is given, since adaptive execution would merge partitions that
    are as small as a list of files is, and leave the files to one task.
    """
    return frame.repartition(min(max(1, rows), _MOST_TASKS))


def row_keys(doc_id="doc_id", text="text"):
    """Two independent hashes that name a row by its id and whole text.

    Rows that agree in both id and text share a key; they also share every
    result that follows from the text.
    """
    return [F.xxhash64(doc_id, text).alias("key_a"),
            F.xxhash64(F.lit("second"), doc_id, text).alias("key_b")]


KEYS = ["key_a", "key_b"]


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(),
          "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
          "array<string>": pa.list_(pa.string())}


def arrow_schema(text):
    """The Arrow schema of "name type, name type"."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in text.split(", "))])


def arrow_batch(rows, schema):
    """Tuples as a record batch."""
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def let(value, use):
    """``use`` of a value, which is worked out once however often the result names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_BLOCK = 128


def running(numbers, combine, levels=2):
    """For each number of an array, ``combine`` over all before it, from 0.

    An array that grows by one is copied each time, so it is done in blocks, and
    blocks of blocks. ``combine`` must be associative, with 0 changing nothing.
    """
    def plain(array):
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(array, first, lambda s, x: F.struct(
            combine(s["at"], x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")), lambda s: s["out"])

    def placed(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: combine(s, x)))
        return F.flatten(F.zip_with(blocks, running(totals, combine, levels - 1), lambda b, before: F.transform(
            plain(b), lambda x: combine(before, x))))

    def cut(array):
        starts = F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), F.lit(_BLOCK))
        return let(F.transform(starts, lambda at: F.slice(array, at + 1, _BLOCK)), placed)

    return let(numbers, cut) if levels else plain(numbers)
