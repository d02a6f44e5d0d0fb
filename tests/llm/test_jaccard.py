import random
import re
from itertools import combinations

import pytest

from ridecells.llm import jaccard
from ridecells.llm.jaccard import _asked, _least_overlap, _prefix_size, connected, first_of_each, near_duplicates, shingles
from tests.llm.helpers import ODD_TEXTS, documents


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def expected(texts, ids, size, percent):
    sets = [shingle_set(t, size) for t in texts]
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            label[top(i)] = top(j)
    groups = {}
    for i in range(len(texts)):
        groups.setdefault(top(i), []).append(i)
    smallest = {i: min((ids[j] for j in g if ids[j] is not None), default=None) for g in groups.values() for i in g}
    return [(ids[i], len(sets[i]), smallest[i]) for i in range(len(texts))]


def varied(seed, copies, words=120):
    """Families of near copies with edits of growing size, over a shared passage."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(25))
    texts = []
    for family in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, words))]
        for c in range(copies):
            own = list(base)
            for _ in range(c % 7):
                own[rng.randrange(len(own))] = f"x{family}{rng.randrange(3)}"
            texts.append(passage + " " + " ".join(own) if c % 5 else " ".join(own))
    return texts


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_components_against_all_pairs(spark, rows, size, percent):
    texts = [*varied(1, 20), *ODD_TEXTS, *ODD_TEXTS[:6], "One two", "one  TWO", "a b c", "c b a"]
    ids = list(range(len(texts)))
    found = near_duplicates(documents(spark, texts, ids).repartition(6), size, percent)
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(expected(texts, ids, size, percent))


@pytest.mark.parametrize("size, percent, edits", [(3, 90, (2, 5)), (5, 80, (3, 6))])
def test_copies_of_one_text_around_the_threshold(spark, rows, monkeypatch, size, percent, edits):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    places = rng.sample(range(150), 24)
    texts = [" ".join(base)]
    for _ in range(90):
        own = list(base)
        for place in rng.sample(places, rng.randrange(*edits)):
            own[place] = f"x{place}-{rng.randrange(2)}"
        texts.append(" ".join(own[:rng.randrange(144, 151)]))
    want = expected(texts, range(len(texts)), size, percent)
    assert 10 < len({w[2] for w in want}) < 85
    met, plain = [], jaccard._linked

    def counting(docs, pairs, *rest):
        met.append(pairs.distinct().count())
        return plain(docs, pairs, *rest)

    monkeypatch.setattr(jaccard, "_linked", counting)
    for share in (16, 4):
        monkeypatch.setattr(jaccard, "_PREFIX_SHARE", share)
        found = near_duplicates(documents(spark, texts), size, percent)
        assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(want)
    assert max(met) < len(texts) * 8


def test_a_passage_that_many_share_gives_no_candidates(spark, rows, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join([*(f"a{d}-{i}" for i in range(30)), passage, *(f"b{d}-{i}" for i in range(30))]) for d in range(40)]
    met, plain = [], jaccard._differences

    def counting(docs, members, *rest):
        met.append(members.count())
        return plain(docs, members, *rest)

    monkeypatch.setattr(jaccard, "_differences", counting)
    monkeypatch.setattr(jaccard, "_BATCH_SHARE", 1 << 30)
    found = near_duplicates(documents(spark, texts), 3, 90)
    assert rows(found, "doc_id", "n_shingles", "component_id") == [(d, 118, d) for d in range(40)]
    assert met == [0]


def test_prefixes_hold_the_shingles_asked_for():
    rng = random.Random(5)
    for _ in range(300):
        percent = rng.choice([80, 90])
        common = rng.randrange(1, 400)
        most = 100 * common // percent - common
        extra = rng.randrange(most + 1)
        tokens = rng.sample(range(10_000), common + most)
        x = sorted(tokens[:common + extra])
        y = sorted(tokens[:common] + tokens[common + extra:])
        if 100 * common < percent * (len(x) + len(y) - common):
            continue
        px, py = x[:_prefix_size(len(x), percent)], y[:_prefix_size(len(y), percent)]
        assert len(set(px) & set(py)) >= min(_asked(len(x)), _asked(len(y)))
        assert common >= max(_least_overlap(len(x), percent), _least_overlap(len(y), percent))


def test_shingle_counts():
    assert len(shingles("a b c a b c", 3)) == 3 and len(shingles("A", 3)) == 1 and len(shingles(" \n", 3)) == 0
    assert (shingles("One TWO three four", 3) == shingles("one two\tthree\x0bfour", 3)).all()
    assert len(shingles("é É", 1)) == 2


def test_labels_of_a_chain(spark, rows):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in [*range(20), *range(30, 33)]], "a binary, b binary")
    assert rows(connected(links)) == sorted((bytes([i]), bytes([0 if i < 25 else 30])) for i in [*range(21), *range(30, 34)])


def test_one_of_each_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    near = text.replace("w49", "other")
    docs = documents(spark, [near, text, text, text, "", "", None, "alone", text], [5, 3, 3, None, 7, 7, 8, 9, 4])
    kept = first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "", r.score) for r in kept.collect()) == [
        (3, text, "kept"), (7, "", "kept"), (7, "", "kept"), (8, "", "kept"), (9, "alone", "kept")]


def test_null_ids_and_no_documents(spark, rows):
    found = near_duplicates(documents(spark, ["a b c", "a b c", "x"], [None, 4, None]), 3, 90)
    assert sorted(found.select("n_shingles", "component_id").collect(), key=str) == [(1, 4), (1, 4), (1, None)]
    assert near_duplicates(documents(spark, []), 3, 90).collect() == []
    assert first_of_each(documents(spark, [])).collect() == []
