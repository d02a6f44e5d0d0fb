"""Order MinHash fingerprints of whole texts.

A text's k-mers of words are numbered by occurrence. Each of ``ENTRIES`` hash
functions picks the ``PICKED`` smallest of them; their hashes, in the order in
which the k-mers stand in the text, make one entry. Two texts agree in an entry
only if they share the picked k-mers and their order, so the share of equal
entries falls with the edits between them, moves included.

Words lie between ASCII white space and longer ones are cut every ``_LONGEST``
bytes. Equal texts have equal fingerprints. Null and empty texts, and such of
white space only, have the fingerprint of zeros; fewer words than ``K`` are one
k-mer.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema

ENTRIES = 64
PICKED = 2
K = 2
SEED = 20
_LONGEST = 32
_AT_ONCE = 1 << 21
_KEPT_WORDS = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
_SEEDS, _FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, ENTRIES), np.uint64)[:, :, None] | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= _KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mixed(h):
    h = (h ^ (h >> np.uint64(30))) * _SPREAD
    return h ^ (h >> np.uint64(27))


def numbered_kmers(text):
    """A hash of each k-mer of words with its number among equal ones, in text order."""
    words = text.encode().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(max(words, key=len)) > _LONGEST:
        words = [w[i:i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - K + 1)
    kmers = hashes[:n]
    for i in range(1, min(K, len(words))):
        kmers = _mixed(kmers) * _MIX + hashes[i:i + n]
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    number = np.empty(n, np.uint64)
    number[order] = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return _mixed(_mixed(kmers) + number * _MIX)


def order_minhash(text):
    """The fingerprint as ``ENTRIES`` unsigned 32-bit integers."""
    kmers = numbered_kmers(text)
    entries = np.zeros(ENTRIES, np.uint64)
    if not len(kmers):
        return entries.astype(np.uint32)
    step = max(1, _AT_ONCE // len(kmers))
    for at in range(0, ENTRIES, step):
        values = (kmers ^ _SEEDS[at:at + step]) * _FACTORS[at:at + step]
        rows, picked = np.arange(len(values)), []
        for _ in range(min(PICKED, len(kmers))):
            smallest = values.argmin(axis=1)
            values[rows, smallest] = np.uint64(0xFFFFFFFFFFFFFFFF)
            picked.append(smallest)
        entry = np.zeros(len(values), np.uint64)
        for places in np.sort(np.stack(picked), axis=0):
            entry = _mixed(entry * _MIX + kmers[places])
        entries[at:at + step] = entry >> np.uint64(32)
    return entries.astype(np.uint32)


def likeness(one, other):
    """Share of equal entries, 0 to 1."""
    return float(np.mean(one == other))


def _hex(entries):
    return entries.astype(">u4").tobytes().hex()


def fingerprints(docs):
    """(doc_id, n_chars, fingerprint) of every document; n_chars counts code points."""
    layout = "doc_id bigint, n_chars bigint, fingerprint string"

    def mark(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield arrow_batch([(doc_id, len(text or ""), _hex(order_minhash(text))) for doc_id, text in rows], schema)

    schema = arrow_schema(layout)
    return docs.select("doc_id", "text").mapInArrow(mark, layout)


_LEAST = -(1 << 63)


def _ranges(docs, rows_each):
    """Smallest and largest id of each range, ascending; null ids count as the smallest of all.

    Spark's range partitioning deals the ids alone; the ranges it found, one row
    each, are then fixed and serve to deal the texts.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(_LEAST)).alias("id"))
    n = max(1, ids.count() // rows_each)
    found = ids.repartitionByRange(n, "id").groupBy(F.spark_partition_id()).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    found = sorted(tuple(r)[1:] for r in found.collect())
    return np.array(found, np.int64).reshape(-1, 2)


def with_next(docs, rows_each=2000):
    """Every document beside the next one in descending order of id, in ranges sorted by id.

    Rows: range, extra, id, text. Within a range they are sorted; an extra row,
    at its end, is the first of the next range and gives the last row its next.
    After the last range comes the first. Null ids come last, rows of one id in
    order of their texts.
    """
    ranges = _ranges(docs, rows_each)

    def deal(batches):
        lows, highs = ranges[:, 0], ranges[:, 1]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            at = np.searchsorted(lows, ids, "right") - 1
            leads = np.flatnonzero(ids == highs[at])
            own = len(lows) - 1 - at  # the largest ids are in range 0
            number = np.concatenate([own, (own[leads] - 1) % len(lows)]).astype(np.int32)
            extra = np.concatenate([np.zeros(len(ids), bool), np.ones(len(leads), bool)])
            rows = np.concatenate([np.arange(len(ids)), leads])
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(extra), batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))],
                names=["range", "extra", "id", "text"])

    filled = docs.select(F.coalesce("doc_id", F.lit(_LEAST)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = filled.mapInArrow(deal, "range int, extra boolean, id bigint, text string")
    return dealt.repartition(max(1, len(ranges)), "range").sortWithinPartitions("range", "extra", F.desc("id"), "text")


def edited_text(text, following):
    """The text, its last half replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compared_with_edits(docs):
    """Every document's fingerprint beside those of its edited text and of the next document.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. A single document is its own next.
    """
    layout = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def compare(batches):
        last = own = None  # (range, id, text) that waits for its next, and its fingerprint
        for batch in batches:
            out = []
            for number, extra, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                mark = None
                if last is not None and last[0] == number:
                    edited = edited_text(last[2], text)
                    edited_mark, mark = order_minhash(edited), order_minhash(text)
                    out.append((None if last[1] == _LEAST else last[1], len(last[2]), hashlib.sha256(edited.encode()).hexdigest(),
                                _hex(own), _hex(edited_mark), likeness(own, edited_mark), likeness(own, mark)))
                last = None if extra else (number, doc_id, text)
                own = None if extra else order_minhash(text) if mark is None else mark
            yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    return with_next(docs).mapInArrow(compare, layout)
