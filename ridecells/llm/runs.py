"""Periodic runs of words in whole texts, by multi-scale minimizers.

A run is a stretch of words with smallest period q that is at least
``max(LEAST, TIMES * q)`` words long and can't be extended. Periods below
``SHORT`` are found by comparing the words with themselves at each lag. For
longer ones there is one scale k = SHORT, 2 SHORT, 4 SHORT ... for the periods
from k to 2k - 1. At a scale every k words are hashed, and a place is kept if
its hash is the smallest among some 2k + 1 neighbouring places. Such a window
spans 3k words, so a run of four periods holds it twice, one period apart, with
the same smallest hash at the same place in it: every run has two kept places
of equal hash at the distance of its period. These pairs are extended word by
word, so results are exact.

Stretches of k words that themselves lie in a run of period k / 4 or less are
never kept. A window inside a run of period k or more holds others, since it
would otherwise have that smaller period throughout. Equal hashes that are left
lie more than k / 4 apart, which bounds the pairs of a place.

Texts are worked on many at a time: their words are numbered and laid out one
after the other, with a number of its own after each text that no run crosses.
At each scale only the texts that are long enough remain.

Words lie between ASCII white space. Null and empty texts have no words and no
runs. A null doc_id is not altered by ``looped``. Repeated rows each have their
result; an empty table gives no rows; other columns are not read.
"""

import hashlib
import zlib

import numpy as np

from ridecells.llm.common import arrow_batch, arrow_schema

LEAST = 6
TIMES = 4
SHORT = 8
#: Words laid out at a time; a longer text is worked on alone.
_AT_ONCE = 1 << 18

_FIRST, _SECOND, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def words_of(text):
    """The words as UTF-8."""
    return text.encode().split() if text else []


def _mixed(h):
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _joined(h, k):
    """Hashes of 2k words from those of k words."""
    return _mixed(h[:-k] * _FIRST + h[k:] * _SECOND) if len(h) > k else h[:0]


def _windowed(values, size, pick):
    """``pick`` (np.minimum or np.maximum) over every full window of the size."""
    width = 1
    while 2 * width <= size:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return pick(values[:-rest], values[rest:]) if rest else values


def _kept_places(hashes, size):
    """Places whose hash is the smallest of a full window that holds them."""
    least = _windowed(hashes, size, np.minimum)
    none = np.zeros(size - 1, hashes.dtype)
    return np.flatnonzero(_windowed(np.concatenate([none, least, none]), size, np.maximum) == hashes)


def _equal_pairs(hashes, places, k):
    """Pairs of places of equal hash, k to 2k - 1 apart, as (first, distance)."""
    order = np.lexsort((places, hashes[places]))
    at, h = places[order], hashes[places][order]
    first, distance = [], []
    for step in range(1, len(at)):
        gap = at[step:] - at[:-step]
        near = (h[step:] == h[:-step]) & (gap < 2 * k)
        if not near.any():
            break
        near &= gap >= k
        first.append(at[:-step][near])
        distance.append(gap[near])
    if not first:
        return []
    first, distance = np.concatenate(first), np.concatenate(distance)
    order = np.lexsort((first, distance))
    return list(zip(first[order].tolist(), distance[order].tolist()))


def _agreeing(a, b, backwards=False):
    """How many words agree from the start (or end) of two equally long views."""
    done, step = 0, 64
    while done < len(a):
        upto = min(len(a), done + step)
        x, y = (a[len(a) - upto:len(a) - done][::-1], b[len(b) - upto:len(b) - done][::-1]) if backwards else (a[done:upto], b[done:upto])
        differs = x != y
        if differs.any():
            return done + int(differs.argmax())
        done, step = upto, 2 * step
    return done


def _factors(n):
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return found + [n] * (n > 1)


def _is_smallest(numbers, start, end, period):
    """Whether no smaller period holds: such a one would divide this one, as the stretch has it several times."""
    return not any(np.array_equal(numbers[start:end - p], numbers[start + p:end]) for p in (period // f for f in _factors(period)))


def _long_enough(length, period):
    return length >= max(LEAST, TIMES * period)


def _by_lag(numbers, period):
    same = np.zeros(len(numbers) - period + 2, np.int8)
    same[1:-1] = numbers[period:] == numbers[:-period]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2] + period
    long = ends - starts >= max(LEAST, TIMES * period)
    return [(s, e, period) for s, e in zip(starts[long].tolist(), ends[long].tolist()) if _is_smallest(numbers, s, e, period)]


def _extended(numbers, pairs):
    """The runs that the pairs lie in."""
    found, last = [], (0, 0, 0)
    for at, period in pairs:
        if period == last[2] and at < last[1] - period:
            continue
        start = at - _agreeing(numbers[:at], numbers[period:at + period], backwards=True)
        end = at + period + _agreeing(numbers[at:len(numbers) - period], numbers[at + period:])
        last = (start, end, period)
        if _long_enough(end - start, period) and _is_smallest(numbers, start, end, period):
            found.append(last)
    return found


def runs_in(texts):
    """For each text, a list of numbers of its words, its runs (start, length, period) by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    found = [[] for _ in texts]
    top = max((max(t) for t in texts if len(t)), default=0) + 1

    def laid_out(which):
        ends = np.cumsum(sizes[which] + 1)
        numbers = np.concatenate([part for i in which for part in (np.asarray(texts[i], np.int64), [top + i])])
        return numbers, ends - sizes[which] - 1

    def add(which, starts, runs):
        owners = np.searchsorted(starts, [s for s, _, _ in runs], "right") - 1
        for o, (s, e, p) in zip(owners.tolist(), runs):
            found[which[o]].append((s - int(starts[o]), e - s, p))

    which = np.flatnonzero(sizes >= LEAST)
    if not len(which):
        return found
    numbers, starts = laid_out(which)
    add(which, starts, [r for period in range(1, SHORT) if period < len(numbers) for r in _by_lag(numbers, period)])
    k = SHORT
    while len(which := np.flatnonzero(sizes >= TIMES * k)):
        numbers, starts = laid_out(which)
        hashes, width = _mixed(numbers.astype(np.uint64) + _FIRST), 1
        while width < k:
            hashes, width = _joined(hashes, width), 2 * width
        periodic = np.zeros(len(hashes), bool)
        for i, begin in zip(which.tolist(), starts.tolist()):
            for start, length, period in found[i]:
                if 4 * period <= k <= length:
                    periodic[begin + start:begin + start + length - k + 1] = True
        hashes[periodic] = np.iinfo(np.uint64).max
        if len(hashes) >= 2 * k + 1:
            places = _kept_places(hashes, 2 * k + 1)
            add(which, starts, _extended(numbers, _equal_pairs(hashes, places[~periodic[places]], k)))
        k *= 2
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def looped(doc_id, words):
    """The words of the contract's altered text: in a tenth of the documents the tail repeats itself."""
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a:a + p]
    return words[:a] + (loop * ((n - a) // p + 1))[:n - a]


def strongest(runs):
    """The run with the greatest length / period, compared exactly; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _row(doc_id, words, runs):
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    text = b" ".join(w for w, k in zip(words, kept.tolist()) if k) if runs else b" ".join(words)
    best = strongest(runs)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *facts, listed.encode(), text


def _rows(docs):
    """One row per (doc_id, words) of a group."""
    number = {}
    numbered = [[number.setdefault(w, len(number)) for w in words] for _, words in docs]
    for (doc_id, words), runs in zip(docs, runs_in(numbered)):
        yield _row(doc_id, words, runs)


def _grouped(docs):
    group, size = [], 0
    for doc_id, words in docs:
        if group and size + len(words) > _AT_ONCE:
            yield group
            group, size = [], 0
        group.append((doc_id, words))
        size += len(words)
    if group:
        yield group


def _over_groups(docs, layout, altered, finish):
    schema = arrow_schema(layout)

    def work(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            words = ((i, words_of(t.as_py())) for i, t in zip(ids, texts))
            for group in _grouped((i, looped(i, w) if altered else w) for i, w in words):
                yield arrow_batch([finish(row) for row in _rows(group)], schema)

    return docs.select("doc_id", "text").mapInArrow(work, layout)


_FACTS = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint"


def without_repeats(docs):
    """doc_id, facts of the runs, ``runs`` (lines of start,length,period) and ``collapsed``: the text with one period of each run."""
    return _over_groups(docs, f"{_FACTS}, runs string, collapsed string", False,
                        lambda row: (*row[:6], row[6].decode(), row[7].decode()))


def run_digests(docs):
    """The same over texts altered by ``looped``, with digests in place of the texts."""
    return _over_groups(docs, f"{_FACTS}, runs_sha256 string, collapsed_sha256 string", True,
                        lambda row: (*row[:6], *(hashlib.sha256(part).hexdigest() for part in row[6:])))
