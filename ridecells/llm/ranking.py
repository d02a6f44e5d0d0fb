"""The best documents for each item by exact integer scores, with pair-bound MaxScore.

Terms are ASCII letters and digits and all signs beyond ASCII, A to Z in lower
case. Three steps:

1. ``collection_counts``: N, L and the document frequency of every term, summed
   in each task before they are shuffled.
2. ``index``: documents are cut into shards of at most ``SHARD_DOCUMENTS`` where
   they lie, without a shuffle. A shard is one row: for each term of the items a
   list of documents and impacts, and for pairs of terms that the items hold the
   intersection of their lists, with the documents' joint weighted impacts.
3. ``search``: an item's terms are its pairs. A pair adds at most the largest of
   its joint maximum and its terms' own maxima, which is less than the sum of
   the two maxima unless one document has both. The pairs with the smallest
   bounds whose sum doesn't reach the score to beat are left out of the search
   for candidates; a candidate that can't reach it with the bounds that are left
   is dropped before those pairs are read. The score to beat starts at the tenth
   best joint impact and at the best found in the task's earlier shards.

A task hands on ten documents per item, of which the best ten over all tasks are
kept. Items are worked on in blocks of about ``ITEMS_AT_ONCE``, dealt by their
hash, so what is sent to the tasks does not grow with either table.

Null texts have no terms. An item without terms, or without a document of a
score above 0, has no rows. Items that agree in id and text count once; items of
one id and different texts are ranked apart. Repeated document rows are
documents of their own; equal scores go by ascending doc_id, null ids last. No
documents or no items give no rows. Other columns are not read.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema, stored

BEST = 10
ITEMS_AT_ONCE = 256
SHARD_DOCUMENTS = 8192
#: Words in a shard, over which it is closed early.
_SHARD_WORDS = 1 << 21
_COUNTED_TERMS = 500_000

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text):
    """All terms of a text in order, as UTF-8."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def collection_counts(docs):
    """One stored row (term, df, total) per term; the row of a null term has N and L."""
    layout = "term string, df bigint, total bigint"
    schema = arrow_schema(layout)

    def count(batches):
        df, with_terms, total = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0):
                found = terms_of(text.as_py())
                df.update(set(found))
                with_terms += bool(found)
                total += len(found)
                if len(df) > _COUNTED_TERMS:
                    yield arrow_batch([(t.decode(), n, 0) for t, n in df.items()], schema)
                    df.clear()
        yield arrow_batch([*((t.decode(), n, 0) for t, n in df.items()), (None, with_terms, total)], schema)

    counted = docs.select("text").mapInArrow(count, layout)
    return stored(counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")), "collection-counts")


def item_terms(items):
    """(item, item_id, block, terms): one stored row per different item with terms."""
    layout = "item bigint, item_id string, block bigint, terms array<string>"
    schema = arrow_schema(layout)

    def read(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            rows = [(item, item_id, block, sorted({t.decode() for t in terms_of(text)})) for item, item_id, block, text in zip(*columns)]
            yield arrow_batch(rows, schema)

    items = items.select("item_id", "text").distinct()
    blocks = max(1, -(-items.count() // ITEMS_AT_ONCE))
    item = F.xxhash64("item_id", "text")
    keyed = items.select(item.alias("item"), F.col("item_id").cast("string"), F.pmod(item, F.lit(blocks)).alias("block"), "text")
    return stored(keyed.mapInArrow(read, layout).where(F.size("terms") > 0), "item-terms"), blocks


def weighted_items(items, counts):
    """(item, item_id, terms) with terms as an array of (df, term, w), frequent ones first; terms of no document are left out.

    The weight uses the number of documents with terms, which the null term's row of ``counts`` has.
    """
    n = counts.where(F.col("term").isNull()).select(F.coalesce("df", F.lit(0)).alias("n")).first()
    known = counts.where(F.col("term").isNotNull()).select("term", "df").withColumn(
        "w", F.floor(1000 * F.log((F.lit(2.0 * (n[0] if n else 0)) + 2) / (2 * F.col("df") + 1))).cast("long"))
    each = items.select("item", "item_id", F.explode("terms").alias("term")).join(known, "term")
    return each.groupBy("item", "item_id").agg(F.sort_array(F.collect_list(F.struct("df", "term", "w")), asc=False).alias("terms"))


class Asked:
    """The terms, weights and pairs of a block of items, numbered.

    A unit is a pair of terms next to each other by frequency, or the single
    term that is left; it holds the numbers of its terms and of its pair (or -1).
    """

    def __init__(self, rows):
        self.term, self.weight, self.pair = {}, [], {}
        self.items = []
        for row in rows:
            numbers = []
            for _, term, w in row["terms"]:
                key = term.encode()
                if key not in self.term:
                    self.term[key] = len(self.term)
                    self.weight.append(w)
                numbers.append(self.term[key])
            units = []
            for a, b in zip(numbers[::2], numbers[1::2]):
                pair = (min(a, b), max(a, b))
                units.append((*pair, self.pair.setdefault(pair, len(self.pair))))
            units += [(n, -1, -1) for n in numbers[len(numbers) // 2 * 2:]]
            self.items.append((row["item"], row["item_id"], units))


def _cut(keys, *columns):
    """Where each of the sorted keys' stretches begins, and the distinct keys."""
    begins = np.flatnonzero(np.diff(keys, prepend=-1)) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.append(begins, len(keys))


class Shard:
    """Lists of one shard: documents and impacts of each term, documents and joint weighted impacts of each pair.

    Documents are numbered in the order of ``doc_ids``, which ascends.
    """

    def __init__(self, doc_ids, terms, starts, docs, impacts, pairs, pair_starts, pair_docs, joint):
        self.doc_ids = doc_ids
        self.term = {t: (docs[a:b], impacts[a:b]) for t, a, b in zip(terms.tolist(), starts[:-1].tolist(), starts[1:].tolist())}
        self.pair = {p: (pair_docs[a:b], joint[a:b]) for p, a, b in zip(pairs.tolist(), pair_starts[:-1].tolist(), pair_starts[1:].tolist())}


_SHARD = "doc_ids array<bigint>, terms array<int>, starts array<int>, docs array<int>, impacts array<int>, pairs array<int>, pair_starts array<int>, pair_docs array<int>, joint array<bigint>"
_NO_ID = np.iinfo(np.int64).max


def _shard_row(ids, sizes, numbers, asked, n_docs, n_terms):
    """The lists of a shard from its documents' ids, sizes and term numbers (-1 for terms that no item has)."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in sizes], np.int64)[order]
    owner = np.repeat(rank, sizes)
    seen = numbers >= 0
    key, tf = np.unique(numbers[seen].astype(np.int64) * len(ids) + owner[seen], return_counts=True)
    term, doc = key // len(ids), key % len(ids)
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
    terms, starts = _cut(term)
    lists = {t: slice(a, b) for t, a, b in zip(terms.tolist(), starts[:-1].tolist(), starts[1:].tolist())}
    at = np.full(len(ids), -1)
    pairs, pair_starts, pair_docs, joint, first = [], [0], [], [], -1
    for (a, b), pair in sorted(asked.pair.items()):
        if a not in lists or b not in lists:
            continue
        if a != first:  # at[d] is the place of document d in the list of a
            at[:] = -1
            at[doc[lists[a]]] = np.arange(lists[a].start, lists[a].stop)
            first = a
        place = at[doc[lists[b]]]
        both = np.flatnonzero(place >= 0)
        if len(both):
            pairs.append(pair)
            pair_docs.append(doc[lists[b]][both])
            joint.append(asked.weight[a] * impact[place[both]] + asked.weight[b] * impact[lists[b]][both])
            pair_starts.append(pair_starts[-1] + len(both))
    joined = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pair_docs, joint))
    return ids[order], terms, starts, doc, impact, np.array(pairs, np.int64), np.array(pair_starts), *joined


def index(docs, asked, n_docs, n_terms, shard_documents=SHARD_DOCUMENTS):
    """Stored shards of the documents, for the terms and pairs that are asked for."""
    schema = arrow_schema(_SHARD)

    def build(batches):
        ids, sizes, numbers, held = [], [], [], 0
        number = asked.term.get

        def shard():
            row = _shard_row(np.array(ids, np.int64), np.array(sizes, np.int64), np.concatenate(numbers), asked, n_docs, n_terms)
            arrays = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, f.type.value_type)) for c, f in zip(row, schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(text.as_py())
                if not found:
                    continue
                ids.append(_NO_ID if doc_id is None else doc_id)
                sizes.append(len(found))
                numbers.append(np.fromiter((number(t, -1) for t in found), np.int32, len(found)))
                held += len(found)
                if len(ids) == shard_documents or held >= _SHARD_WORDS:
                    yield shard()
                    ids, sizes, numbers, held = [], [], [], 0
        if ids:
            yield shard()

    return stored(docs.select("doc_id", "text").mapInArrow(build, _SHARD), "shards")


def _least_of_best(scores, best=BEST):
    """The score of the tenth best, or 0 if there are fewer."""
    return int(np.partition(scores, -best)[-best]) if len(scores) >= best else 0


def _bounded_units(shard, units, weight):
    """The item's units in this shard with their bounds, smallest bound first."""
    found = []
    for a, b, pair in units:
        own = [weight[t] * int(shard.term[t][1].max()) for t in (a, b) if t in shard.term]
        if own:
            together = int(shard.pair[pair][1].max()) if pair in shard.pair else 0
            found.append((max(*own, together) if len(own) > 1 else own[0], a, b))
    return sorted(found)


def best_in_shard(shard, units, weight, to_beat=0, best=BEST):
    """(scores, documents) of the shard's best documents that reach ``to_beat``, with whole scores.

    ``to_beat`` is a score that as many documents elsewhere are known to have;
    documents that equal it are kept, as their ids may be smaller.
    """
    bounded = _bounded_units(shard, units, weight)
    for _, _, pair in units:
        if pair in shard.pair:
            to_beat = max(to_beat, _least_of_best(shard.pair[pair][1], best))
    sums = np.cumsum([bound for bound, _, _ in bounded])
    left_out = int(np.searchsorted(sums, max(to_beat, 1)))  # documents in these alone can't reach the score
    scores, held = np.zeros(len(shard.doc_ids), np.int64), np.zeros(len(shard.doc_ids), bool)
    for _, a, b in bounded[left_out:]:
        for t in (a, b):
            if t in shard.term:
                docs, impacts = shard.term[t]
                scores[docs] += weight[t] * impacts.astype(np.int64)
                held[docs] = True
    candidates = np.flatnonzero(held)
    for i in range(left_out - 1, -1, -1):
        to_beat = max(to_beat, _least_of_best(scores[candidates], best))
        candidates = candidates[scores[candidates] + sums[i] >= to_beat]
        if not len(candidates):
            break
        for t in bounded[i][1:]:
            if t in shard.term:
                docs, impacts = shard.term[t]
                place = np.minimum(np.searchsorted(docs, candidates), len(docs) - 1)
                scores[candidates] += np.where(docs[place] == candidates, weight[t] * impacts[place].astype(np.int64), 0)
    whole = scores[candidates]
    reach = max(to_beat, _least_of_best(whole, best), 1)
    candidates = candidates[whole >= reach]
    order = np.lexsort((candidates, -scores[candidates]))[:best]  # documents stand in ascending order of id
    return scores[candidates[order]], candidates[order]


def search(shards, asked, best=BEST):
    """(item, item_id, doc_id, score): each task's best documents for each item."""
    layout = "item bigint, item_id string, doc_id bigint, score bigint"
    schema = arrow_schema(layout)

    def look(batches):
        top = [[] for _ in asked.items]  # (-score, doc_id) of the best so far, in order
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(*(column[row].values.to_numpy() for column in batch.columns))
                for i, (_, _, units) in enumerate(asked.items):
                    to_beat = -top[i][-1][0] if len(top[i]) == best else 0
                    scores, docs = best_in_shard(shard, units, asked.weight, to_beat, best)
                    if len(docs):
                        top[i] = sorted(top[i] + list(zip((-scores).tolist(), shard.doc_ids[docs].tolist())))[:best]
        yield arrow_batch([(item, item_id, None if doc == _NO_ID else doc, -score)
                           for (item, item_id, _), found in zip(asked.items, top) for score, doc in found], schema)

    return shards.mapInArrow(look, layout)


def ranked(docs, items, best=BEST, shard_documents=SHARD_DOCUMENTS):
    """item_id, rank, doc_id and score of each item's best documents."""
    kind = items.schema["item_id"].dataType
    counts = collection_counts(docs)
    items, blocks = item_terms(items)
    weighted = stored(weighted_items(items.drop("block"), counts).join(items.select("item", "block"), "item"), "weighted-items")
    total = counts.where(F.col("term").isNull()).first()
    found = None
    for block in range(blocks):
        asked = Asked(weighted.where(F.col("block") == block).orderBy("item").collect())  # about ITEMS_AT_ONCE rows
        shards = index(docs, asked, total["df"] if total else 0, total["total"] if total else 0, shard_documents)
        part = search(shards, asked, best)
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
