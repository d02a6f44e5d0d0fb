"""Secrets in whole texts, by an inverted index of trigrams.

Native DataFrame operations only. Each rule's regular expression is read for
strings that every match must hold; their trigrams, in lower case, make a
Boolean query: all of some clauses, each any of some alternatives, each all of
some trigrams. The index holds, for the trigrams that any rule asks for, which
documents have them. Postings are intersected per alternative and clause; the
documents that remain are candidates and the expression itself is run on their
whole texts. A rule without mandatory trigrams runs on every text.

A null text counts as empty and has no secrets. Repeated rows give repeated
results. Spans count code points, end exclusive. Documents are known by two
hashes of id and text, so copies under different ids spread over the cluster.
"""

import operator
from dataclasses import dataclass
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import functions as F

from ridecells.llm.common import KEYS, let, row_keys, running, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches that don't overlap.

    A match is dropped after it was found if its group has under ``least`` characters.
    """
    kind: str
    regex: str
    group: int = 0
    least: int = 0


def _either_case(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ["password", "passwd", "secret", "token", "api_?key"]))

#: The base rules.
BASE = [
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # a run of 32 or more is what remains of all runs
]
#: Well-known formats beside them.
RULES = [
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}"),
]

_MOST_STRINGS = 64
_MOST_SIGNS = 8


def _grams(string):
    return frozenset(string[i:i + 3] for i in range(len(string) - 2))


def _clause(strings):
    """Alternatives (sets of trigrams), or None if some string has no trigram."""
    sets = {_grams(s) for s in strings}
    return None if frozenset() in sets else [s for s in sets if not any(other < s for other in sets)]


def _parts(parsed):
    """What the expression demands in order: a set of strings, clauses, or None for anything."""
    for kind, of in parsed:
        if kind is kinds.LITERAL:
            yield {chr(of).lower()}
        elif kind is kinds.IN:
            signs = {chr(c).lower() for k, c in of if k is kinds.LITERAL}
            exact = len(signs) <= _MOST_SIGNS and all(k is kinds.LITERAL for k, _ in of)
            yield signs if exact else None
        elif kind is kinds.SUBPATTERN:
            yield from _parts(of[-1])
        elif kind is kinds.BRANCH:
            each = [list(_parts(branch)) for branch in of[1]]
            joined = [_joined(parts) for parts in each]
            if all(strings is not None for strings, _ in joined):
                yield set().union(*(strings for strings, _ in joined))
            else:
                yield None
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
            low, high, inner = of
            once, _ = _joined(list(_parts(inner)))
            if (low, high) == (0, 1) and once is not None:
                yield {""} | once
            else:
                for _ in range(min(low, 3)):
                    yield from _parts(inner)
                if (low, high) not in ((1, 1), (2, 2), (3, 3)):
                    yield None
        elif kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
            yield {""}
        else:
            yield None


def _joined(parts):
    """(all strings that the parts make, None); or (None, clauses)."""
    strings, clauses = {""}, []

    def close():
        clause = _clause(strings)
        if clause:
            clauses.append(clause)

    exact = True
    for part in parts:
        more = {a + b for a in strings for b in part} if part is not None else None
        if more is not None and len(more) <= _MOST_STRINGS:
            strings = more
            continue
        exact = False
        close()
        strings = part if part is not None else {""}
    if exact:
        return strings, None
    close()
    return None, clauses


def trigram_query(regex):
    """Clauses that every match fulfils; none if the expression demands no trigram.

    Each clause is a list of alternatives, each a set of trigrams in lower case.
    """
    strings, clauses = _joined(list(_parts(parser.parse(regex))))
    if strings is not None:
        clause = _clause(strings)
        clauses = [clause] if clause else []
    return clauses


def _queries(rules):
    """One row per rule, clause, alternative and trigram, with how many each needs."""
    rows = []
    for rule in rules:
        clauses = trigram_query(rule.regex)
        for c, clause in enumerate(clauses):
            for a, grams in enumerate(clause):
                rows += [(g, rule.kind, len(clauses), c, a, len(grams)) for g in sorted(grams)]
    return rows, "gram string, kind string, n_clauses int, clause int, alternative int, n_grams int"


def trigram_index(docs, grams):
    """Stored postings (gram, key_a, key_b): which documents have the trigrams, in either case.

    Trigrams that no rule asks for would never be looked up, so they are not indexed.
    """
    lowered = docs.select(*row_keys(), F.lower("text").alias("lowered"))
    held = F.array_compact(F.array(*[F.when(F.contains("lowered", F.lit(g)), g) for g in grams]).cast("array<string>"))
    return stored(lowered.select(*KEYS, F.explode(held).alias("gram")), "trigrams")


def candidates(docs, rules):
    """(key_a, key_b, kinds): the rules whose trigram queries a document fulfils."""
    spark = docs.sparkSession
    rows, layout = _queries(rules)
    index = trigram_index(docs, sorted({r[0] for r in rows}))
    hits = index.join(F.broadcast(spark.createDataFrame(rows, layout)), "gram")  # some dozens of rows, from the rules alone
    alternatives = hits.groupBy(*KEYS, "kind", "n_clauses", "clause", "alternative", "n_grams").agg(
        F.size(F.collect_set("gram")).alias("found")).where(F.col("found") == F.col("n_grams"))
    fulfilled = alternatives.groupBy(*KEYS, "kind", "n_clauses").agg(
        F.size(F.collect_set("clause")).alias("found")).where(F.col("found") == F.col("n_clauses"))
    return fulfilled.groupBy(*KEYS).agg(F.collect_set("kind").alias("kinds"))


_SPANS = "array<struct<start: int, rank: int, kind: string, end: int>>"


def _spans(text, rule, rank):
    """Spans of a rule's matches: running sums over what lies between them."""
    between = F.split(text, rule.regex, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))

    def placed(pieces):
        def span(piece, at):
            start = at + F.char_length(piece["gap"])
            end = start + F.char_length(piece["match"])
            return F.when(F.char_length(piece["kept"]) >= rule.least, F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end")))

        sizes = F.transform(pieces, lambda p: F.char_length(p["gap"]) + F.char_length(p["match"]))
        return F.array_compact(F.zip_with(pieces, running(sizes, operator.add), span))

    return let(F.slice(F.arrays_zip(between.alias("gap"), whole.alias("match"), group.alias("kept")), 1, F.size(whole)), placed)


def find_secrets(docs, rules=RULES, name="secrets"):
    """All columns of the documents and ``secrets``: spans by start, then as the rules are listed.

    A span has start, rank (the rule's place in the list), kind and end.
    Another ``name`` may be given; a column of that name is replaced.
    """
    internal = {"key_a": "_secret_key_a", "key_b": "_secret_key_b", "kinds": "_secret_kinds"}
    chosen = candidates(docs, [r for r in rules if trigram_query(r.regex)]).withColumnsRenamed(internal)
    keyed = docs.drop(name).select("*", *[k.alias(f"_secret_key_{x}") for k, x in zip(row_keys(), "ab")])
    text, found = F.coalesce(F.col("text"), F.lit("")), []
    for rank, rule in enumerate(rules):
        asked = F.array_contains("_secret_kinds", rule.kind) if trigram_query(rule.regex) else F.rlike(text, F.lit(rule.regex))
        found.append(F.when(asked, _spans(text, rule, rank)).otherwise(F.array().cast(_SPANS)))
    joined = keyed.join(chosen, ["_secret_key_a", "_secret_key_b"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.drop(name).columns], F.array_sort(F.concat(*found)).alias(name))


def span_text(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


_CHUNK = 256


def _cut(chunks, start, end):
    """Code points start to end of a text in chunks, read from the chunks that hold them."""
    first = (start / _CHUNK).cast("int")
    held = F.slice(chunks, first + 1, F.ceil(end / _CHUNK).cast("int") - first)
    return F.array_join(held, "").substr(start - first * _CHUNK + 1, end - start)


def masked_text(text, spans, mask="[secret]"):
    """The text with every stretch that spans cover replaced by one mask."""
    def masked(chunks):
        def kept(span, covered):
            return F.when(span["start"] >= covered, F.concat(_cut(chunks, covered, span["start"]), F.lit(mask))).otherwise("")

        before = running(F.transform(spans, lambda s: s["end"]), F.greatest)
        last = _cut(chunks, F.array_max(F.transform(spans, lambda s: s["end"])), F.char_length(text))
        return F.concat(F.array_join(F.zip_with(spans, before, kept), ""), last)

    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(whole, masked)).otherwise(text)


def without_secrets(docs, rules=RULES, mask="[secret]"):
    """The documents, all columns, with secrets masked in ``text``; ``n_chars``, where there, counts the new text."""
    found = find_secrets(docs, rules, "_spans").withColumn("_masked", masked_text(F.col("text"), F.col("_spans"), mask))
    changed = {"text": F.col("_masked")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("_spans") > 0, F.char_length("_masked")).otherwise(F.col("n_chars"))
    return found.select(*[changed[c].cast(kind).alias(c) if c in changed else F.col(f"`{c}`") for c, kind in docs.dtypes])
