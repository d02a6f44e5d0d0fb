import hashlib
import random
import zlib

import pytest

from ridecells.llm import runs
from tests.llm.helpers import ODD_TEXTS, documents


def plain_runs(words):
    """Every lag compared word by word."""
    found, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            part = words[start:start + length]
            if length >= max(6, 4 * q) and all(part[p:] != part[:-p] for p in range(1, q)):
                found.add((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *facts, hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def mixture(rng):
    """Words with runs of many periods, nested ones and near misses."""
    words = []
    for _ in range(rng.randint(1, 5)):
        words += [rng.randrange(6) for _ in range(rng.randint(0, 20))]
        period = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 40, 64]))]
        if rng.random() < 0.4:
            period = period[:2] * rng.randint(1, 12) + period
        words += period * rng.randint(2, 6) + period[:rng.randint(0, len(period))]
        if words and rng.random() < 0.5:
            words[rng.randrange(len(words))] = 99
    return words


def test_runs_agree_with_every_lag():
    rng = random.Random(5)
    for _ in range(60):
        texts = [mixture(rng) for _ in range(rng.randint(1, 8))] + [[], [1], [3] * 400]
        assert runs.runs_in(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_few_different_words(letters):
    rng = random.Random(letters)
    texts = [[rng.randrange(letters) for _ in range(rng.randint(0, 300))] for _ in range(40)]
    assert runs.runs_in(texts) == [plain_runs(t) for t in texts]


def test_period_boundaries_at_exactly_four_periods():
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 255]:
        whole, short = [*range(q)] * 4, ([*range(q)] * 4)[:-1]
        assert runs.runs_in([[-1, *whole, -2]])[0] == ([(1, 4 * q, q)] if 4 * q >= 6 else [])
        assert runs.runs_in([[-1, *short, -2]])[0] == []


def test_a_period_that_is_itself_repetitive():
    period = [1] * 60 + [2]
    text = period * 9
    assert runs.runs_in([text])[0] == plain_runs(text)


def test_a_very_long_text_of_one_period():
    period = [*range(25_000)]
    assert runs.runs_in([period * 8 + [-1]])[0] == [(0, 200_000, 25_000)]
    assert runs.runs_in([[7] * 1_000_000])[0] == [(0, 1_000_000, 1)]


def test_documents_agree_with_the_plain_version(spark, rows):
    rng = random.Random(9)
    texts = [*ODD_TEXTS, *[" ".join(map(str, mixture(rng))) for _ in range(120)], "a b " * 40, "a b " * 9 + " "]
    found = runs.run_digests(documents(spark, texts))
    assert rows(found) == sorted(plain_row(i, t) for i, t in enumerate(texts))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_given_documents_agree_with_the_plain_version(spark, rows):
    from ridecells.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/documents.parquet").collect()
    short = {r["doc_id"]: r["text"] for r in given if len(r["text"] or "") < 30_000}
    found = [r for r in rows(QUERIES["op12_periodic_runs"][0](spark, folder)) if r[0] in short]
    assert found == sorted(plain_row(i, t) for i, t in short.items())


def test_collapsed_texts(spark, rows):
    table = documents(spark, ["x " + "a b c " * 5 + "y", None, "no repeats"])
    found = rows(runs.without_repeats(table), "doc_id", "n_runs", "start", "runs", "collapsed")
    assert found == [(0, 1, 1, "1,15,3\n", "x a b c y"), (1, 0, None, "", ""), (2, 0, None, "", "no repeats")]


def test_null_ids_repeated_rows_and_empty_tables(spark, rows):
    table = documents(spark, ["a " * 9, "a " * 9, "a " * 9], ids=[None, 7, 7])
    assert [r[1:5] for r in runs.run_digests(table).collect()] == [(1, 0, 9, 1)] * 3
    assert rows(runs.run_digests(documents(spark, []))) == []


def test_ties_take_the_first_run():
    assert runs.strongest([(0, 8, 2), (9, 12, 3), (30, 4, 1)]) == (0, 8, 2)
    assert runs.strongest([(0, 8, 2), (9, 13, 3)]) == (9, 13, 3)
