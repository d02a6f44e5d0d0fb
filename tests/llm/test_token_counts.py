import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridecells.llm.token_counts import LEAF_WORDS, CountTree, change, count_trees, edited
from ridecells.llm.tokens import Encoder
from tests.llm.helpers import LONG, ODD_TEXTS, VOCABULARY, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def whole(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_trees_against_whole_encoding(library):
    encode = Encoder(VOCABULARY).ids
    for text in ODD_TEXTS:
        tree = CountTree.of(text or "", encode)
        assert tree.tokens[1] == whole(library, text) and tree.chars[1] == len(text or "")


def test_random_edits_against_whole_encoding(library):
    encode, rng = Encoder(VOCABULARY).ids, random.Random(4)
    alphabet = ["a", "word ", " ", "  ", "é", "'s", "<|endoftext|>", "\n", "9", "!?", "long " * 40, ""]
    for n in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        tree = CountTree.of(text, encode)
        for _ in range(12):
            start = rng.randrange(-1, len(text) + 2)
            end = start + rng.choice([0, 1, 2, 7, 300])
            new = "".join(rng.choice(alphabet) for _ in range(rng.randrange(3)))
            low = min(max(0, start), len(text))
            expected = text[:low] + new + text[min(max(low, end), len(text)):]
            text, _ = tree.edit(text, start, end, new, encode)
            assert text == expected
            assert tree.chars[1] == len(text) and tree.tokens[1] == whole(library, text), (n, text[-80:])
            assert (tree.tokens[1:tree.width] == tree.tokens[2::2] + tree.tokens[3::2]).all()


def test_little_is_encoded_anew():
    encode = Encoder(VOCABULARY).ids
    tree = CountTree.of(LONG, encode)
    leaf = max(len(w) + 1 for w in LONG.split(" ")) * LEAF_WORDS
    for place in (0, len(LONG) // 2, len(LONG)):
        _, n = tree.edit(LONG, place, place, "", encode)
        assert n <= leaf


def test_documents_against_whole_encoding(spark, library):
    edits = F.array(change(F.lit(0), F.lit(8), F.lit("Start ")), change(F.char_length("text") / 2, F.char_length("text") / 2 + 4, F.lit(None).cast("string")))
    docs = documents(spark)
    once = {r.doc_id: r for r in edited(docs, edits, VOCABULARY, with_trees=True).collect()}
    for doc_id, text in enumerate(ODD_TEXTS):
        t = "Start " + (text or "")[8:]
        half = len(text or "") // 2
        t = t[:half] + t[half + 4:] if text is not None else t
        r = once[doc_id]
        if text is not None:
            assert (r.text, r.n_tokens, r.n_edited_tokens, r.n_edited_chars) == (t, whole(library, text), whole(library, t), len(t))
    trees = count_trees(docs, VOCABULARY)
    kept = {r.doc_id: r for r in edited(trees, edits, VOCABULARY, with_trees=True).collect()}
    assert kept == once


def test_no_edits_null_ids_and_no_documents(spark, rows):
    none = F.lit(None).cast("array<struct<start:int,end:int,replacement:string>>")
    found = edited(documents(spark, ["two words", None, "two words"], [None, 1, None]), none, VOCABULARY)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(1, 0, 0, 0, 0), (None, 2, 2, 9, 0), (None, 2, 2, 9, 0)], key=str)
    assert edited(documents(spark, []), none, VOCABULARY).collect() == []
