import random
import zlib

import pytest
from pyspark.sql import functions as F

from ridecells.llm import sharding
from ridecells.llm.sharding import kd_shards
from tests.llm.helpers import ODD_TEXTS, documents


def plain_tree(rows, shards):
    """(size, tie, dims) rows to shards, by sorting."""
    lows, highs = [min(c) for c in zip(*(r[2] for r in rows))], [max(c) for c in zip(*(r[2] for r in rows))]
    out, first = {}, [0]

    def grow(part, count):
        if count == 1 or not part:
            for r in part:
                out[r] = first[0]
            first[0] += count
            return
        width = [(max(r[2][d] for r in part) - min(r[2][d] for r in part)) / max(1, highs[d] - lows[d]) for d in range(len(lows))]
        dim, want, total = width.index(max(width)), sum(r[0] for r in part) * (count // 2) // count, 0
        part = sorted(part, key=lambda r: (r[2][dim], r[1]))
        for at, r in enumerate(part):
            total += r[0]
            if total >= max(1, want):
                break
        grow(part[:at + 1], count // 2)
        grow(part[at + 1:], count - count // 2)
    grow(rows, shards)
    return out


def check(docs, found, shards):
    dims = [F.coalesce(c.cast("long"), F.lit(0)) for c in sharding.document_dimensions().values()]
    rows = [(len((r.text or "").encode()) + 1, r.tie, tuple(r.dims)) for r in docs.select(
        "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - sharding._TIE_BITS).alias("tie"), F.array(*dims).alias("dims")).collect()]
    expected = plain_tree(rows, shards)
    assert sorted((r.size, r.shard) for r in found) == sorted((k[0], s) for k, s in expected.items())


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_against_a_plain_tree(spark, shards):
    rng = random.Random(shards)
    texts = [*ODD_TEXTS, *(" ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(200))) for _ in range(150))]
    docs = documents(spark, texts).withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string"))).cache()
    found = kd_shards(docs, shards).collect()
    check(docs, found, shards)
    for s in range(shards):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_shared_values_are_split(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_ROWS_A_PLACE", 10)
    docs = documents(spark, ["the same text of all documents"] * 400)
    found = kd_shards(docs, target_bytes=400 * 31 // 4).collect()
    counts = [sum(r.shard == s for r in found) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(counts[s])) for s in range(4))


def test_repeated_rows_null_ids_and_no_documents(spark):
    found = kd_shards(documents(spark, ["a", "a", "a", None], [1, 1, None, None]), 2).collect()
    assert len(found) == 4 and {r.shard for r in found} <= {0, 1}
    assert kd_shards(documents(spark, []), 8).collect() == []
    assert kd_shards(documents(spark, []), target_bytes=100).collect() == []
