import hashlib
import random

import numpy as np

from ridecells.llm import fingerprints
from ridecells.llm.fingerprints import K, PICKED, compared_with_edits, edited_text, likeness, numbered_kmers, order_minhash
from tests.llm.helpers import ODD_TEXTS, documents


def plain_fingerprint(text):
    """The same by dictionaries and sorting, one k-mer at a time."""
    kmers = [int(k) for k in numbered_kmers(text)]
    if not kmers:
        return [0] * fingerprints.ENTRIES
    out = []
    for seed, factor in zip(fingerprints._SEEDS.ravel(), fingerprints._FACTORS.ravel()):
        values = [((k ^ int(seed)) * int(factor)) % (1 << 64) for k in kmers]
        picked = sorted(range(len(kmers)), key=lambda i: (values[i], i))[:PICKED]
        entry = 0
        for i in sorted(picked):
            entry = (entry * int(fingerprints._MIX) + kmers[i]) % (1 << 64)
            entry = ((entry ^ (entry >> 30)) * int(fingerprints._SPREAD)) % (1 << 64)
            entry ^= entry >> 27
        out.append(entry >> 32)
    return out


def test_against_a_plain_version():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 10, 200):
        text = " ".join(rng.choice("abcde") for _ in range(n))
        assert order_minhash(text).tolist() == plain_fingerprint(text)


def test_occurrences_are_numbered():
    kmers = numbered_kmers("a b a b a b")
    assert len(kmers) == 7 - K and len(set(kmers.tolist())) == len(kmers)
    once, more = set(numbered_kmers("a b c").tolist()), set(numbered_kmers("a b c a b").tolist())
    assert once <= more


def test_order_and_edits_count():
    words = [f"w{i}" for i in range(300)]
    text, moved, edited = " ".join(words), " ".join(words[150:] + words[:150]), " ".join(words[:290] + ["x"] * 10)
    other = " ".join(f"v{i}" for i in range(300))
    own = order_minhash(text)
    assert likeness(own, order_minhash(text)) == 1.0
    assert 0.7 < likeness(own, order_minhash(edited)) < 1
    assert 0.2 < likeness(own, order_minhash(moved)) < 0.8
    assert likeness(own, order_minhash(other)) == 0


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(str(i) for i in range(500))
    whole = order_minhash(text)
    monkeypatch.setattr(fingerprints, "_AT_ONCE", 1200)
    assert (order_minhash(text) == whole).all()


def check(spark, texts, ids, rows_each):
    docs = [(i, t or "") for i, t in zip(ids, texts)]
    docs.sort(key=lambda d: (d[0] is None, -(d[0] or 0), d[1].encode()))
    expected = []
    for at, (doc_id, text) in enumerate(docs):
        following = docs[(at + 1) % len(docs)][1]
        edited = edited_text(text, following)
        marks = [order_minhash(t) for t in (text, edited, following)]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *(m.astype(">u4").tobytes().hex() for m in marks[:2]),
                         likeness(marks[0], marks[1]), likeness(marks[0], marks[2])))
    with_each = fingerprints.with_next
    fingerprints.with_next = lambda d: with_each(d, rows_each)
    try:
        found = compared_with_edits(documents(spark, texts, ids).repartition(4)).collect()
    finally:
        fingerprints.with_next = with_each
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_next_documents_in_many_ranges(spark):
    texts = [t for t in ODD_TEXTS] + [f"text number {i} with words {i * i}" for i in range(40)]
    ids = random.Random(3).sample(range(-100, 1000), len(texts))
    check(spark, texts, ids, 3)
    check(spark, texts, ids, 1000)


def test_repeated_and_null_ids(spark):
    check(spark, ["b b", "a", "c c c c", "c c c c", "x y z", None], [5, 5, 5, 1, None, None], 1)


def test_single_and_no_documents(spark):
    check(spark, ["only this one"], [4], 10)
    assert compared_with_edits(documents(spark, [])).collect() == []
    assert np.all(order_minhash(None) == 0) and likeness(order_minhash(""), order_minhash(None)) == 1.0
