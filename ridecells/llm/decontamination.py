"""Benchmark passages in documents, by a distributed positional inverted index.

Native DataFrame operations only. Items are cut into windows of consecutive
words. How often each word of the items occurs in all documents tells which of
a window's words are rarest; those are its anchors, and only their postings
(word, document, position) are stored. A document can hold a window only where
the postings of its anchors agree once each position is reduced by the word's
place in the item. Such places are then compared word by word with the whole
item in the document's own words, so matches are exact.

Documents are known by two hashes of id and text (``row_keys``), so copies under
different ids spread over the cluster and repeated rows share their matches.

Null texts have no words. Items without words match nothing. An item of fewer
words than a window is one window. Repeated items count once; items with a null
id are matched like others. No documents or no items give documents without
matches. Other columns of either table are not read.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridecells.llm.common import KEYS, row_keys, stored

WINDOW_WORDS = 13
ANCHORS = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Digits, letters a to z and all signs beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text):
    """A to Z in lower case and nothing else changed."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text):
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def phrase_items(phrases):
    """(item, item_id, item_words), one row per different item with words."""
    found = phrases.select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id"), words(F.col("text")).alias("item_words"))
    return stored(found.where(F.size("item_words") > 0).dropDuplicates(["item"]), "items")


def _document_words(docs):
    """(key_a, key_b, n_words, position, term), one row per word.

    Exploding the one list of words keeps it from being made again for its size
    and for the filter on empty lists that Spark adds before their words.
    """
    held = docs.select(*row_keys(), F.explode(F.array(words(F.col("text")))).alias("words"))
    return held.select(*KEYS, F.size("words").alias("n_words"), F.posexplode("words").alias("position", "term"))


def term_counts(docs, terms):
    """How often each of the terms occurs in all documents: (term, n)."""
    return _document_words(docs).select("term").join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def anchored_windows(items, counts, window=WINDOW_WORDS, anchors=ANCHORS):
    """(item, windows): each window's start, and the places in the item of its rarest words.

    Windows with a word that no document has are left out: they occur nowhere.
    """
    size = F.least(F.size("item_words"), F.lit(window))
    cut = items.select("item", size.alias("size"), "item_words", F.explode(F.sequence(F.lit(0), F.size("item_words") - size)).alias("start"))
    each = cut.select("item", "size", "start", F.posexplode(F.expr("slice(item_words, start + 1, size)")).alias("at", "term"))
    whole = Window.partitionBy("item", "start")  # a group is one window
    ranked = each.join(counts, "term").select(
        "item", "start", "size", (F.col("start") + F.col("at")).alias("place"), "term",
        F.row_number().over(whole.orderBy("n", "at")).alias("rank"), F.count("*").over(whole).alias("known"))
    ranked = ranked.where(F.col("known") == F.col("size")).where(F.col("rank") <= anchors)
    per_window = ranked.groupBy("item", "start").agg(
        F.collect_list(F.struct("place", "term")).alias("anchors"))
    return stored(per_window.groupBy("item").agg(F.collect_list(F.struct("start", "anchors")).alias("windows")), "windows")


def positional_index(docs, terms):
    """Stored postings of the terms, (term, key_a, key_b, position, n_words), and one of each text's last word.

    The latter tell how many words the texts have, so no other pass must split
    them all: ``n_words`` is set there, and its term is null unless asked for.
    """
    last = F.col("position") + 1 == F.col("n_words")
    marked = _document_words(docs).join(terms.withColumn("asked", F.lit(True)), "term", "left").where(F.col("asked") | last)
    return stored(marked.select(F.when(F.col("asked"), F.col("term")).alias("term"), *KEYS, "position",
                                F.when(last, F.col("n_words")).alias("n_words")), "postings")


def _word_counts(index):
    """(key_a, key_b, n_words) of the texts with words."""
    return index.where(F.isnotnull("n_words")).groupBy(*KEYS).agg(F.max("n_words").alias("_phrase_counted"))


def _anchor_postings(index, windows):
    """Postings of anchors with the item's shift in the document that each implies."""
    anchors = windows.select("item", F.explode("windows").alias("w")).select("item", F.explode("w.anchors").alias("a"))
    anchors = anchors.select("item", "a.place", "a.term").distinct()
    return index.join(anchors, "term").select(*KEYS, "item", "place", (F.col("position") - F.col("place")).alias("shift"))


def _indexed(docs, phrases, window, anchors):
    """(items, windows, index), all stored."""
    items = phrase_items(phrases)
    terms = items.select(F.explode("item_words").alias("term")).distinct()
    windows = anchored_windows(items, term_counts(docs, stored(terms, "terms")), window, anchors)
    rare = windows.select(F.explode("windows").alias("w")).select(F.explode("w.anchors.term").alias("term")).distinct()
    return items, windows, positional_index(docs, stored(rare, "anchor-terms"))


def _with_matches(docs, phrases, window, anchors, slop=None):
    """All columns of the documents, their words and their exact matches, under names of this module.

    With a slop also ``_phrase_near``, the ids of the items near which the document comes.
    """
    items, windows, index = _indexed(docs, phrases, window, anchors)
    together = _anchor_postings(index, windows).groupBy(*KEYS, "item", "shift").agg(F.collect_set("place").alias("places"))
    agreed = F.exists("windows", lambda w: F.forall(w["anchors"], lambda a: F.array_contains(F.col("places"), a["place"])))
    shifts = together.join(windows, "item").where(agreed).groupBy(*KEYS, "item").agg(F.collect_list("shift").alias("shifts"))
    own = {"key_a": "_phrase_key_a", "key_b": "_phrase_key_b"}
    found = shifts.join(items, "item").groupBy(*KEYS).agg(  # a group is one document, with each item's words once
        F.collect_list(F.struct("item_id", "item", "shifts", "item_words")).alias("_phrase_found"))
    if slop is not None:
        near = _near(index, windows, slop).select(*KEYS, "item").distinct().join(items, "item")
        near = near.groupBy(*KEYS).agg(F.collect_set(F.col("item_id").cast("string")).alias("_phrase_near"))
        found = found.join(near, KEYS, "full")
    found = _word_counts(index).join(found, KEYS, "left").withColumnsRenamed(own)

    texts = docs.select("*", *[k.alias(n) for k, n in zip(row_keys(), own.values())])
    # Only candidates are split. Exploding the one list of words keeps later filters from moving below
    # this point, where each comparison would split the text again.
    split = F.when(F.isnotnull("_phrase_found"), words(F.col("text")))
    read = texts.join(found, list(own.values()), "left").select("*", F.explode(F.array(split)).alias("_phrase_words"))

    def matched(f):
        size = F.least(F.size(f["item_words"]), F.lit(window))
        starts = F.sequence(F.lit(0), F.size(f["item_words"]) - size)

        def at(shift):
            same = F.transform(f["item_words"], lambda w, i: F.when(F.get("_phrase_words", shift + i) == w, "1").otherwise("0"))
            flags = F.array_join(same, "")
            hit = F.filter(starts, lambda s: flags.substr(s + 1, size) == F.repeat(F.lit("1"), size))
            return F.transform(hit, lambda s: F.struct(
                f["item_id"].alias("item_id"), f["item"].alias("item"), s.alias("window"), (s + shift).alias("position"), size.alias("size")))

        return F.flatten(F.transform(f["shifts"], at))

    matches = F.when(F.isnotnull("_phrase_words"), F.flatten(F.transform("_phrase_found", matched)))
    near = [] if slop is None else [F.array_sort(F.coalesce("_phrase_near", F.array().cast("array<string>"))).alias("_phrase_near")]
    return read.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce("_phrase_counted", F.lit(0)).cast("long").alias("_phrase_n_words"),
                       matches.alias("_phrase_matches"), *near)


def document_matches(docs, phrases, window=WINDOW_WORDS, anchors=ANCHORS):
    """Every document with its exact matches.

    Returns doc_id, n_words and ``matches``: for each place where a window
    occurs, item_id, item, window (its first word in the item), position (in the
    document) and size, in words.
    """
    return _with_matches(docs.select("doc_id", "text"), phrases, window, anchors).toDF("doc_id", "text", "n_words", "matches").drop("text")


def phrase_matches(docs, phrases, window=WINDOW_WORDS, anchors=ANCHORS):
    """One row per exact match: doc_id, item_id, window, position, size."""
    return document_matches(docs, phrases, window, anchors).select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", "m.item_id", "m.window", "m.position", "m.size")


def _near(index, windows, slop):
    """(key_a, key_b, item, window, position): places where all anchors of a window stand nearly as in the item."""
    width = slop + 1
    # Stretches of twice the width, each beginning a width after the last: near shifts share one.
    stretch = F.explode(F.array(F.floor(F.col("shift") / width), F.floor(F.col("shift") / width) - 1)).alias("stretch")
    near = _anchor_postings(index, windows).select(*KEYS, "item", "place", "shift", stretch)
    near = near.groupBy(*KEYS, "item", "stretch").agg(F.collect_set(F.struct("place", "shift")).alias("seen"))

    def fits(w, low):
        return F.forall(w["anchors"], lambda a: F.exists("seen", lambda s: (
            (s["place"] == a["place"]) & s["shift"].between(low, low + slop))))

    lows = F.array_sort(F.array_distinct(F.col("seen.shift")))
    fitting = F.transform("windows", lambda w: F.struct(
        w["start"].alias("window"), F.filter(F.col("lows"), lambda low: fits(w, low)).alias("fit")))
    found = near.select(*KEYS, "item", "seen", lows.alias("lows")).join(windows, "item")
    found = found.select(*KEYS, "item", F.explode(fitting).alias("f")).select(*KEYS, "item", "f.window", F.explode("f.fit").alias("low"))
    return found.select(*KEYS, "item", "window", (F.col("low") + F.col("window")).alias("position")).distinct()


def proximity_matches(docs, phrases, slop, window=WINDOW_WORDS, anchors=ANCHORS):
    """Windows whose rarest words all occur in a document, nearly as they stand in the item.

    The words' shifts differ by ``slop`` at most. Returns doc_id, item_id, window
    and position, the smallest shift plus window. Every exact match is among them.
    """
    items, windows, index = _indexed(docs, phrases, window, anchors)
    found = _near(index, windows, slop)
    return docs.select("doc_id", *row_keys()).join(found, KEYS).join(items, "item").select("doc_id", "item_id", "window", "position")


def contamination(docs, phrases, slop=None):
    """Every document with n_words, n_hit, n_items, item_ids and whether it is contaminated.

    A word is hit if it lies in a match; a document is contaminated if at least
    a twentieth of its words, and one at least, are hit. Items with a null id
    count for the words, and are neither counted nor named. With a ``slop`` also
    n_near and near_ids, the items with proximity matches of that slop; they
    include item_ids and don't make a document contaminated.
    """
    found = _with_matches(docs.select("doc_id", "text"), phrases, WINDOW_WORDS, ANCHORS, slop)
    matches, n_words = F.col("_phrase_matches"), F.col("_phrase_n_words")
    ids = F.array_sort(F.array_distinct(F.filter(F.transform(matches, lambda m: m["item_id"].cast("string")), F.isnotnull)))
    near = [] if slop is None else [F.size("_phrase_near").cast("long").alias("n_near"), F.col("_phrase_near").alias("near_ids")]
    counted = found.select(
        "doc_id", n_words.alias("n_words"), _hit_words(matches).alias("n_hit"),
        F.coalesce(ids, F.array().cast("array<string>")).alias("item_ids"), *near)
    return counted.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        _contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"), *([] if slop is None else ["n_near", "near_ids"]))


def _hit_words(matches):
    hit = F.flatten(F.transform(matches, lambda m: F.sequence(m["position"], m["position"] + m["size"] - 1)))
    return F.size(F.coalesce(F.array_distinct(hit), F.array().cast("array<int>"))).cast("long")


def _contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_contaminated(docs, phrases):
    """The documents, all columns, that aren't contaminated."""
    found = _with_matches(docs, phrases, WINDOW_WORDS, ANCHORS)
    return found.where(~_contaminated(_hit_words("_phrase_matches"), F.col("_phrase_n_words"))).drop("_phrase_n_words", "_phrase_matches")
