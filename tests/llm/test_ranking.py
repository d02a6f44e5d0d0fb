import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ridecells.llm import ranking
from tests.llm.helpers import ODD_TEXTS, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, best=10):
    """Every document scored for every item."""
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for doc_id, c in counted:
            m = 10 + (90 * c.total() * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(plain_terms(text)) if t in c)
            if score > 0:
                scored.append((-score, math.inf if doc_id is None else doc_id))
        found += [(item_id, rank, None if d == math.inf else d, -s) for rank, (s, d) in enumerate(sorted(scored)[:best], 1)]
    return found


def collection(rng, n):
    """Texts of frequent and rare words, copies among them."""
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.2:
            texts.append(rng.choice(texts))
        else:
            texts.append(" ".join(f"{rng.choice('wW')}{int(rng.expovariate(0.06))}" for _ in range(rng.randint(0, 60))))
    return texts


@pytest.mark.parametrize("shard", [7, 8192])
def test_against_every_document(spark, shard):
    rng = random.Random(shard)
    texts = [*ODD_TEXTS, *collection(rng, 300)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    asked = [(i, " ".join(f"w{int(rng.expovariate(0.04))}" for _ in range(rng.randint(0, 40)))) for i in range(25)]
    asked += [(90, "ÀÉÎ naïve Straße"), (91, None), (92, "nowhere"), (92, "plain words"), (92, "plain words"), (93, "word7 x y")]
    table = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in asked], "item_id int, text string, term string, rank int")
    found = ranking.ranked(table, items, shard_documents=shard)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(plain_ranking(docs, asked))


def test_blocks_of_items_give_the_same_rows(spark, rows, monkeypatch):
    rng = random.Random(3)
    texts = collection(rng, 80)
    items = spark.createDataFrame([(i, f"w{i} w{i + 1} w0") for i in range(30)], "item_id long, text string")
    whole = rows(ranking.ranked(documents(spark, texts), items))
    monkeypatch.setattr(ranking, "ITEMS_AT_ONCE", 4)
    assert rows(ranking.ranked(documents(spark, texts), items)) == whole


def test_ties_null_ids_and_repeated_rows(spark):
    table = documents(spark, ["same words here"] * 14 + ["other"] * 30, [*range(20, 8, -1), None, 9, *range(100, 130)])
    items = spark.createDataFrame([("a", "SAME words")], "item_id string, text string")
    found = sorted(map(tuple, ranking.ranked(table, items).collect()))
    assert [r[1:3] for r in found] == [(i + 1, d) for i, d in enumerate([9, 9, 10, 11, 12, 13, 14, 15, 16, 17])]
    assert len({r[3] for r in found}) == 1
    few = sorted(map(tuple, ranking.ranked(documents(spark, ["same words", "x", "y"], [None, 2, 3]), items).collect()))
    assert [r[:3] for r in few] == [("a", 1, None)]


def test_empty_tables(spark, rows):
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert rows(ranking.ranked(documents(spark, []), items)) == []
    assert rows(ranking.ranked(documents(spark, [None, "  "]), items)) == []
    assert rows(ranking.ranked(documents(spark), items.limit(0))) == []


def shard_of(texts, items):
    """A shard of the texts, and what is asked of it."""
    df = Counter(t for text in texts for t in set(text.split()))
    asked = ranking.Asked([{"item": i, "item_id": str(i), "terms": [
        (df[t], t, math.floor(1000 * math.log((2 * len(texts) + 2) / (2 * df[t] + 1)))) for t in sorted(words, key=lambda t: -df[t])]}
        for i, words in enumerate(items)])
    numbers = [np.array([asked.term.get(t.encode(), -1) for t in text.split()]) for text in texts]
    row = ranking._shard_row(np.arange(len(texts)), np.array([len(n) for n in numbers]), np.concatenate(numbers), asked, len(texts), sum(map(len, numbers)))
    return ranking.Shard(*row), asked


def test_pair_bounds_hold_and_are_tighter_than_independent_maxima():
    rng = random.Random(1)
    texts = ["a " * rng.randint(1, 9) + "x " * rng.randint(0, 30) for _ in range(50)] + ["b " * rng.randint(1, 9) + "y" for _ in range(50)]
    shard, asked = shard_of(texts + ["a b " + "z " * 200], [["a", "b"]])
    (bound, a, b), = ranking._bounded_units(shard, asked.items[0][2], asked.weight)
    alone = [asked.weight[t] * int(shard.term[t][1].max()) for t in (a, b)]
    assert bound == max(alone) < sum(alone)
    scores, _ = ranking.best_in_shard(shard, asked.items[0][2], asked.weight, best=1)
    assert scores[0] <= bound


def test_units_below_the_score_to_beat_are_not_searched():
    texts = [f"common{i % 3} frequent{i % 2} filler" for i in range(200)] + ["rare1 rare2 filler"] * 12
    shard, asked = shard_of(texts, [["rare1", "rare2", "common0", "frequent1"]])
    read = []

    class Watched(dict):
        def __getitem__(self, key):
            read.append(key)
            return dict.__getitem__(self, key)

    expected, docs = ranking.best_in_shard(shard, asked.items[0][2], asked.weight)
    assert docs.tolist() == list(range(200, 210))
    bounds = ranking._bounded_units(shard, asked.items[0][2], asked.weight)
    assert bounds[0][0] < expected[-1]  # the frequent pair alone never reaches the best ten
    shard.term = Watched(shard.term)
    scores, _ = ranking.best_in_shard(shard, asked.items[0][2], asked.weight, to_beat=int(expected[0]) + bounds[0][0] + 1)
    assert not len(scores) and max(Counter(read).values()) == 1  # each list was read once, for its maximum
