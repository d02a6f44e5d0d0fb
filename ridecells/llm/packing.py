"""Best-fit packing of token pieces by exact complements.

Documents become pieces of at most ``capacity`` tokens. Only the number of
pieces of each length, at most ``capacity`` numbers, is planned on the driver;
the pieces stay where they are. Lengths are taken from the longest down. The
gap that a length leaves is looked up among single lengths, then among sums of
pairs, then of triples that are still available, and a combination that fills
it exactly is used as often as its lengths last. Where none exists the longest
length that fits is added and the rest of the gap is looked up again (best
fit). So a plan has a few thousand patterns at most, however many pieces.

Every piece then gets a place: its number among the pieces of its length picks
the pattern, the sequence and the offset.
"""

from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema, stored
from ridecells.llm.tokens import encoder

CAPACITY = 2048
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Bits for a piece's number among those of its length.
_NUMBER_BITS = 44


def token_pieces(docs, tokenizer, capacity=CAPACITY, end_id=0, with_ids=True):
    """Pieces of the documents' ids, each document followed by ``end_id``.

    Reads ``doc_id`` and ``text`` only. A null or empty text has the end id
    alone; a document longer than ``capacity`` is cut every ``capacity`` tokens.
    Repeated rows give repeated pieces. ``ids`` (little-endian unsigned 32-bit
    integers) comes last, unless ``with_ids`` is off.
    """
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batches):
        encode = encoder(tokenizer).ids
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    out.append((doc_id, piece, at // 4, len(part) // 4, crc32(part), *([part] if with_ids else [])))
            yield arrow_batch(out, schema)

    columns = PIECES + (", ids binary" if with_ids else "")
    schema = arrow_schema(columns)
    return docs.select("doc_id", "text").mapInArrow(cut, columns)


class _Available:
    """Counts by length, with an index of the sums that pairs of lengths make."""

    def __init__(self, counts):
        self.left = counts.astype(np.int64)
        self.left[0] = 0
        self.here = self.left > 0
        self.sums = np.zeros(2 * len(counts), np.int64)  # number of available pairs of each sum
        for length in np.flatnonzero(self.here):
            self._index(length, 1, self.here[:length])
            self.sums[2 * length] += self.left[length] > 1

    def _index(self, length, change, others):
        self.sums[length:length + len(others)] += change * others

    def take(self, needs, times):
        for length, n in needs.items():
            twice = self.left[length] > 1
            self.left[length] -= n * times
            self.sums[2 * length] -= twice and self.left[length] < 2
            if not self.left[length]:
                self.here[length] = False
                self._index(length, -1, self.here)

    def lasts(self, needs):
        return min(self.left[length] // n for length, n in needs.items())

    def pair(self, gap, used):
        """Two lengths that sum to the gap, the most even first, beside those used."""
        if gap < 2 or not self.sums[gap]:
            return None
        small = np.arange(1, gap // 2 + 1)
        for a in small[self.here[small] & self.here[gap - small]][::-1]:
            if self.lasts(Counter([*used, a, gap - a])):
                return [int(a), int(gap - a)]
        return None

    def exact(self, gap, used):
        """One, two or three lengths that fill the gap exactly, or None."""
        if gap < len(self.here) and self.here[gap] and self.lasts(Counter([*used, gap])):
            return [gap]
        if found := self.pair(gap, used):
            return found
        thirds = np.arange(max(1, -(-gap // 3)), gap - 1)
        for c in thirds[self.here[thirds] & (self.sums[gap - thirds] > 0)]:
            if (two := self.pair(gap - int(c), [*used, int(c)])):
                return [int(c), *two]
        return None

    def longest(self, gap, used):
        """The longest available length up to the gap, or None."""
        for length in np.flatnonzero(self.here[:gap + 1])[::-1]:
            if self.lasts(Counter([*used, int(length)])):
                return int(length)
        return None


def plan_patterns(counts, capacity=CAPACITY):
    """Patterns as (lengths in order, how many sequences), for counts by length."""
    stock, patterns = _Available(np.asarray(counts)), []
    for length in range(capacity, 0, -1):
        while stock.left[length]:
            pattern, gap = [length], capacity - length
            while gap:
                found = stock.exact(gap, pattern)
                if not found:
                    one = stock.longest(gap, pattern)
                    if one is None:
                        break
                    found = [one]
                pattern += found
                gap -= sum(found)
            needs = Counter(pattern)
            times = int(stock.lasts(needs))
            stock.take(needs, times)
            patterns.append((pattern, times))
    return patterns


def _places(patterns):
    """Sorted keys (length, first number), with sequence and offset of the first."""
    rows, given, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            rows.append(((length << _NUMBER_BITS) | given[length], sequence, offset))
            given[length] += times
            offset += length
        sequence += times
    rows.sort()
    return [np.array(column, np.int64) for column in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 3


def pack(pieces, capacity=CAPACITY):
    """The pieces with ``sequence_id`` and ``offset``, as few sequences as it can.

    ``pieces`` needs a ``length`` of 1 to ``capacity``; its other columns are
    carried along, but for ``sequence_id``, ``offset``, ``part`` and ``nth``.
    Pieces are numbered by length within the task that made them and the tasks'
    numbers are added up per length, so nothing but the places is shuffled and
    no length, however frequent, is gathered. No pieces give no rows.
    """
    pieces = pieces.drop("sequence_id", "offset", "part", "nth")
    names = pieces.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]

    def number(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = pd.Series(batch.column("length").to_numpy(zero_copy_only=False))
            if len(lengths) and not 1 <= lengths.min() <= lengths.max() <= capacity:
                raise ValueError(f"pieces are 1 to {capacity} tokens long")
            nth = seen[lengths] + lengths.groupby(lengths).cumcount().to_numpy()
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), part), pa.int32()), pa.array(nth, pa.int64())],
                names=[*batch.schema.names, "part", "nth"])

    numbered = stored(pieces.mapInArrow(number, ", ".join([*fields, "part int", "nth bigint"])), "pieces")
    per_part = numbered.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in per_part.groupBy("length").agg(F.sum("n")).collect():  # capacity rows at most
        counts[length] = n
    keys, sequences, offsets = _places(plan_patterns(counts, capacity))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def place(batches):
        for batch in batches:
            of = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            key = (of("length") << _NUMBER_BITS) | (of("first") + of("nth"))
            at = np.searchsorted(keys, key, "right") - 1
            kept = [batch.column(f) for f in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequences[at] + key - keys[at], pa.int64()), pa.array(offsets[at], pa.int64())],
                names=[*names, "sequence_id", "offset"])

    return numbered.join(first, ["part", "length"]).mapInArrow(
        place, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def sequences(packed):
    """One row per sequence: its length and its ids, pieces in their places.

    Needs the ``ids`` of ``token_pieces``. A group is one sequence, so it holds
    ``capacity`` tokens at most.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
