import itertools
import re
from collections import Counter

import pytest

from ridecells.llm.decontamination import contamination, phrase_matches, proximity_matches
from tests.llm.helpers import ODD_TEXTS, documents

ITEM = "One two THREE four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
WORDS = ITEM.split()
SHORT = "rare short item"
ITEMS = [(1, ITEM), (2, SHORT), (10, "É two"), (None, "nameless words here"), (3, None), (4, "?!"), (2, SHORT),
         (5, "the of and the of and the of and the of and the of and")]
TEXTS = [
    "x " + ITEM + " y", " ".join(WORDS[2:15]), " ".join(WORDS[2:14]), " ".join([*WORDS[:8], "x", *WORDS[8:]]),
    "A rare, SHORT... item; rare short item", "é two", "É TWO", "nameless words here", "the of and " * 40, "rare item short",
    " ".join(WORDS[3:]) + " " + " ".join(WORDS), "filler " * 300 + SHORT, "filler " * 57 + SHORT, "filler " * 58 + SHORT,
]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(texts):
    out = []
    for doc_id, text in enumerate(texts):
        w, matches = words(text), set()
        for item_id, item in ITEMS:
            i = words(item)
            m = min(13, len(i))
            matches |= {(item_id, s, p, m) for s in range(len(i) - m + 1) if m for p in range(len(w) - m + 1) if w[p:p + m] == i[s:s + m]}
        hit = {q for _, _, p, m in matches for q in range(p, p + m)}
        ids = sorted({str(i) for i, *_ in matches if i is not None})
        out.append((doc_id, len(w), len(hit), len(ids), ids, bool(hit) and 20 * len(hit) >= len(w), matches))
    return out


def phrases(spark):
    return spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id bigint, text string, item int")


def test_documents_against_plain_search(spark, rows):
    texts = [*TEXTS, *ODD_TEXTS]
    found = contamination(documents(spark, texts), phrases(spark))
    assert rows(found) == sorted(e[:6] for e in expected(texts))


def test_phrases_against_plain_search(spark):
    found = phrase_matches(documents(spark, TEXTS), phrases(spark)).collect()
    assert {tuple(r) for r in found} == {(e[0], *m) for e in expected(TEXTS) for m in e[6]}
    assert len(found) == sum(len(e[6]) for e in expected(TEXTS))


def test_near_matches(spark):
    found = {tuple(r) for r in proximity_matches(documents(spark, TEXTS), phrases(spark), 2).collect()}
    exact = {(r.doc_id, r.item_id, r.window, r.position) for r in phrase_matches(documents(spark, TEXTS), phrases(spark)).collect()}
    assert exact <= found
    assert (3, 1, 0, 0) in found and (9, 2) in {f[:2] for f in found}
    assert not [f for f in found if f[0] == 12 and f[1] == 1]


def plain_near(texts, slop):
    """Item ids near each document, by trying every place of every anchor."""
    documents_words = [words(t) for t in texts]
    counts = Counter(w for d in documents_words for w in d)
    out = []
    for w in documents_words:
        ids = set()
        for item_id, item in ITEMS:
            i = words(item)
            m = min(13, len(i))
            for s in range(len(i) - m + 1) if m else ():
                if any(not counts[x] for x in i[s:s + m]):
                    continue
                anchors = sorted(range(s, s + m), key=lambda p: (counts[i[p]], p))[:2]
                shifts = [[p - a for p, x in enumerate(w) if x == i[a]] for a in anchors]
                if any(max(c) - min(c) <= slop for c in itertools.product(*shifts)):
                    ids.add(item_id)
        out.append(sorted(str(i) for i in ids if i is not None))
    return out


@pytest.mark.parametrize("slop", [0, 2, 7])
def test_contamination_with_near_items(spark, slop):
    texts = [*TEXTS, *ODD_TEXTS]
    found = contamination(documents(spark, texts), phrases(spark), slop).sort("doc_id").collect()
    near = plain_near(texts, slop)
    assert [r.near_ids for r in found] == near and [r.n_near for r in found] == [len(n) for n in near]
    assert all(set(r.item_ids) <= set(r.near_ids) for r in found)
    assert [tuple(r)[:6] for r in found] == [e[:6] for e in expected(texts)]


def test_repetitive_text_against_a_repetitive_item(spark):
    """Each word stands at many places of item and text: many shifts, one list of words for the item."""
    text = "the of and " * 400
    [row] = contamination(documents(spark, [text]), phrases(spark), 2).collect()
    assert (row.n_words, row.n_hit, row.item_ids, row.near_ids) == (1200, 1200, ["5"], ["5"])


def test_repeated_rows_and_null_ids(spark, rows):
    found = contamination(documents(spark, [SHORT, SHORT, SHORT], [1, 1, None]), phrases(spark)).collect()
    assert [(r.n_hit, r.item_ids, r.contaminated) for r in found] == [(3, ["2"], True)] * 3


def test_empty_tables(spark, rows):
    assert contamination(documents(spark, []), phrases(spark)).collect() == []
    assert rows(contamination(documents(spark, ["a b"]), phrases(spark).limit(0))) == [(0, 2, 0, 0, [], False)]
