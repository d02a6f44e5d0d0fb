import struct
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from ridecells.llm.packing import pack, plan_patterns, sequences, token_pieces
from ridecells.llm.tokens import Encoder
from tests.llm.helpers import ODD_TEXTS, VOCABULARY, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def whole(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(library):
    own = Encoder(VOCABULARY)
    assert own.by_pieces
    for text in ODD_TEXTS:
        expected = whole(library, text)
        assert own.ids(text) == struct.pack(f"<{len(expected)}I", *expected), repr(text)[:50]


def test_ids_survive_a_full_store(library, monkeypatch):
    monkeypatch.setattr("ridecells.llm.tokens.KEPT_PIECES", 3)
    own, text = Encoder(VOCABULARY), "one two three four five one two three Four fiVe"
    expected = whole(library, text)
    assert own.ids(text) == struct.pack(f"<{len(expected)}I", *expected)


def fewest(lengths, capacity):
    """Exact number of sequences, by search over what fills the next one."""
    from functools import lru_cache

    @lru_cache(None)
    def need(left):
        if not left:
            return 0
        best, rest = len(left), left[1:]
        seen = set()

        def fill(gap, start, kept):
            nonlocal best
            if kept not in seen:
                seen.add(kept)
                best = min(best, 1 + need(kept))
            for i in range(len(kept)):
                if kept[i] <= gap:
                    fill(gap - kept[i], i, kept[:i] + kept[i + 1:])
        fill(capacity - left[0], 0, rest)
        return best
    return need(tuple(sorted(lengths, reverse=True)))


def test_plan_against_search():
    rng = np.random.default_rng(3)
    over = 0
    for _ in range(40):
        lengths = rng.integers(1, 13, 8)
        patterns = plan_patterns(np.bincount(lengths, minlength=13), 12)
        used = Counter()
        for pattern, times in patterns:
            assert sum(pattern) <= 12
            used.update({k: n * times for k, n in Counter(pattern).items()})
        assert used == Counter(lengths.tolist())
        over += sum(t for _, t in patterns) - fewest(lengths.tolist(), 12)
    assert over <= 2


def test_exact_complements_fill_every_gap():
    # 9 + 3, 8 + (1 + 3), 7 + (1 + 2 + 2): single, pair and triple complements
    patterns = plan_patterns(np.bincount([9, 3, 8, 1, 3, 7, 1, 2, 2], minlength=13), 12)
    assert [sum(p) for p, _ in patterns] == [12, 12, 12]


def test_pack_places_every_piece(spark, library):
    docs = documents(spark)
    rows = pack(token_pieces(docs, VOCABULARY, 64), 64).collect()
    expected = {}
    for doc_id, text in enumerate(ODD_TEXTS):
        ids = [*whole(library, text), 0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            expected[doc_id, piece] = (at, ids[at:at + 64])
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == {
        k: (at, len(ids), crc32(struct.pack(f"<{len(ids)}I", *ids))) for k, (at, ids) in expected.items()}
    assert len(rows) == len(expected)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(len(ids) for _, ids in expected.values())
    assert len(by_sequence) <= -(-total // 64) + 1


def test_sequences_hold_their_ids(spark):
    packed = pack(token_pieces(documents(spark), VOCABULARY, 64), 64).cache()
    whole_rows = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in packed.collect():
        assert whole_rows[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == r.ids


def test_repeated_rows_and_null_ids(spark):
    rows = pack(token_pieces(documents(spark, ["a b", "a b", "a b"], [1, 1, None]), VOCABULARY, 8), 8).collect()
    assert sorted((r.sequence_id, r.offset) for r in rows) == [(0, 0), (0, 3), (1, 0)]


def test_no_documents(spark):
    assert pack(token_pieces(documents(spark, []), VOCABULARY)).collect() == []


def test_too_long_a_piece_is_refused(spark):
    with pytest.raises(Exception, match="pieces are 1 to 4"):
        pack(spark.range(1).selectExpr("5L AS length"), 4).collect()
