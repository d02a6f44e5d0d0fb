"""Documents whose shingle sets are alike, by a grouped prefix join.

Shingles are hashed to 64 bits. Under one order of all shingles, rare before
frequent, two sets that are alike enough share the first few of their common
shingles within a prefix of each (``_prefix_size``). Documents with equal sets
form a class; classes with equal prefixes and sizes form a group, which is
indexed once. Group pairs are counted over the prefix shingles they share, cut
by size and position, expanded to pairs of classes, and those are compared
exactly on the texts of two documents.

This is done twice. First only against one leader per shingle and per group;
the links found give components. Then pairs of all members, but only those that
lie in different components, so large groups of near copies never meet in all
pairs and yet no link that joins two components is lost.

Copies of one text that are just too far apart to link share almost their whole
prefixes. Where a shingle's list is long, its groups therefore don't meet over
what they share, but over what sets them apart: each class is compared with its
list's leader, and the shingles that only one of the two has are its difference.
The symmetric difference of two classes is that of their differences, so two
that link share some of the first elements of theirs, rare before frequent.

The order only decides how many candidates arise: frequent shingles come last,
in steps by how often, and by their hash within a step. Every text is cut into
shingles once; a set's smallest hashes, half as many again as its prefix, are
kept and counted. Frequent are those that stand among many sets' smallest, or
that several documents of one batch share. Only sets whose smallest hold too few
rare shingles are cut from the text again, and kept and counted whole. All tasks
know the frequent ones from maps of fixed size, where a rare shingle may pass for
a frequent one, but for all sets alike.

Nulls and texts without words have an empty set and are linked with nothing.
Rows with a null id take part; a component of such rows alone has a null id.
Repeated rows are equal sets. No documents give no rows. Only ``doc_id`` and
``text`` are read.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ridecells.llm.common import KEYS, arrow_batch, arrow_schema, row_keys, stored

#: Sets whose smallest hashes share a shingle before it counts as frequent.
_PREFIX_SHARE = 16
#: Documents of one batch that share a shingle before it is counted as frequent.
_BATCH_SHARE = 3
_BATCH_HASHES = 500_000
_KEPT_WORDS = 100_000
#: Bits of the maps that keep most texts, and most shingles, from a join that then decides.
_TEXT_BITS = 1 << 22
_SHINGLE_BITS = 1 << 26
#: Steps of frequency, each four times the one before, and the bits of each one's map.
_STEPS = 6
_STEP_BITS = 1 << 24


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= _KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text, size):
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words lie between ASCII white space, A to Z in lower case. Fewer words than
    ``size``, but not none, are one shingle.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    mixed = hashes[:n]
    for i in range(1, min(size, len(words))):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[i:i + n]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def _least_overlap(n, percent):
    """Shingles that a set of n shares with any set that it links to."""
    return -(-percent * n // 100)


def _asked(n):
    """Common shingles asked for within the prefixes."""
    return 1 + n // 40


def _prefix_size(n, percent):
    """A prefix of this size holds the first ``_asked(n)`` shingles common with any linked set."""
    return min(n, n - _least_overlap(n, percent) + _asked(n))


def _kept_size(n, percent):
    """A set's smallest hashes that are kept, so that a prefix can leave out frequent ones."""
    return min(n, _prefix_size(n, percent) * 3 // 2 + 4)


def _rows(batch):
    """The rows of a batch one by one, so that its texts aren't all held twice."""
    for row in zip(*batch.columns):
        yield [value.as_py() for value in row]


def _digests(docs, size, percent):
    """Stored rows: documents (their set's size and key), and shingles frequent in a batch.

    ``least`` holds the smallest hashes of a set, once in a batch.
    """
    layout = "key_a bigint, key_b bigint, doc_id bigint, n bigint, set_key binary, least array<bigint>, shingle bigint, times bigint"

    def digest(batches):
        seen, kept, held = set(), [], 0

        def frequent():
            found, times = np.unique(np.concatenate(kept), return_counts=True) if kept else (np.zeros(0, np.uint64),) * 2
            often = times >= _BATCH_SHARE
            found, times = found[often].view(np.int64), times[often].astype(np.int64)
            none = [pa.nulls(len(found), f.type) for f in list(schema)[:6]]
            return pa.RecordBatch.from_arrays([*none, pa.array(found), pa.array(times)], schema=schema)

        for batch in batches:
            out = []
            for key_a, key_b, doc_id, text in _rows(batch):
                own = shingles(text, size)
                key = xxhash.xxh3_128_digest(own.tobytes())
                least = None
                if len(own) and key not in seen:
                    least = own[:_kept_size(len(own), percent)].view(np.int64)
                    seen.add(key)
                    kept.append(own)
                    held += len(own)
                out.append((key_a, key_b, doc_id, len(own), key, least, None, None))
                if held >= _BATCH_HASHES:
                    yield frequent()
                    seen, kept, held = set(), [], 0
            yield arrow_batch(out, schema)
        yield frequent()

    schema = arrow_schema(layout)
    return stored(docs.select(*row_keys(), "doc_id", "text").mapInArrow(digest, layout), "shingle-digests")


class _BitMap:
    """Which remainders the values of a column leave, known to all tasks: a bounded first filter."""

    def __init__(self, frame, column, size):
        bit = F.pmod(column, F.lit(size)) + 1
        maps = frame.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        bits = np.zeros(size // 8, np.uint8)
        for row in maps.collect():
            own = np.frombuffer(row["bits"], np.uint8)
            bits[(row["bucket"] - 1) * len(own):row["bucket"] * len(own)] = own
        self.size, self.bits = size, frame.sparkSession.sparkContext.broadcast(bits)

    def may_hold(self, values):
        at = values % self.size
        return (self.bits.value[at >> 3] >> (at & 7) & 1).astype(bool)


class _Order:
    """How frequent shingles are, in steps, known to all tasks; the least frequent come first."""

    def __init__(self, counted):
        """Of rows (shingle, times)."""
        most = [_PREFIX_SHARE * 4 ** i for i in range(_STEPS)]
        self.maps = [_BitMap(counted.where(F.col("times") > times), "shingle", _STEP_BITS) for times in most]

    def steps(self, hashes):
        """The step of each shingle, 0 if it is rare."""
        found = np.zeros(len(hashes), np.int8)
        for bits in self.maps:
            found += bits.may_hold(hashes)
        return found


def _settled(batch, percent, order):
    """For each row (set_key, n, least): set_key, n and the prefix, or None where ``least`` holds too few rare shingles."""
    lists = batch.column(2)
    hashes, begin = lists.flatten().to_numpy(), 0
    steps = order.steps(hashes)
    for key, n, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), lists.value_lengths().to_pylist()):
        own, step = hashes[begin:begin + held], steps[begin:begin + held]
        begin += held
        wanted = _prefix_size(n, percent)
        first = own[np.argsort(step, kind="stable")] if held == n else own[step == 0]
        yield key, n, first[:wanted] if len(first) >= wanted else None


def _unsettled(sets, percent, order):
    """(set_key, key_a) of the sets that have too few rare shingles among their smallest, one row each."""
    layout = "set_key binary, key_a bigint"

    def pick(batches):
        for batch in batches:
            short = [first is None for _, _, first in _settled(batch, percent, order)]
            yield batch.select([0, 3]).filter(pa.array(short, pa.bool_()))

    short = sets.mapInArrow(pick, layout).groupBy("set_key").agg(F.min("key_a").alias("key_a"))
    return stored(short, "unsettled")


def _whole_sets(docs, wanted, size):
    """Stored (set_key, n, least) of the wanted rows' texts and some others', with all their shingles."""
    layout = "set_key binary, n bigint, least array<bigint>"
    near_by = _BitMap(wanted, "key_a", _TEXT_BITS)

    def cut(batches):
        for batch in batches:
            out, seen = [], set()
            for (text,) in _rows(batch.filter(pa.array(near_by.may_hold(batch.column(0).to_numpy()))).select([1])):
                own = shingles(text, size)
                key = xxhash.xxh3_128_digest(own.tobytes())
                if len(own) and key not in seen:
                    seen.add(key)
                    out.append((key, len(own), own.view(np.int64)))
            yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    return stored(docs.select(row_keys()[0], "text").mapInArrow(cut, layout), "whole-sets")


def _prefixes(sets, percent, order):
    """Stored (set_key, gid, n, prefix) of the sets that are settled."""
    layout = "set_key binary, gid bigint, n bigint, prefix array<bigint>"

    def cut(batches):
        for batch in batches:
            out = []
            for key, n, prefix in _settled(batch, percent, order):
                if prefix is not None:
                    gid = xxhash.xxh3_64_intdigest(prefix.tobytes() + n.to_bytes(8, "little")) - (1 << 63)
                    out.append((key, gid, n, prefix))
            yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    return stored(sets.select("set_key", "n", "least").mapInArrow(cut, layout), "prefixes")


def _counted_in(sets, more_than):
    each = sets.select(F.explode("least").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("times"))
    return each.where(F.col("times") > more_than)


def _fits(percent, n, other, place, other_place):
    """Whether sets of these sizes can link, if one of the first shingles they share has these places.

    Of the shingles asked for, the last has all but one of the others before it.
    """
    small, large = F.least(n, other), F.greatest(n, other)
    least = F.ceil((percent * (n + other)) / F.lit(100.0 + percent) - 1e-9) - F.floor(small / 40)
    return (100 * small >= percent * large) & (F.least(n - place, other - other_place) >= least)


def _counted(pairs):
    """Group pairs that share as many prefix shingles as both sizes ask for."""
    enough = 1 + F.floor(F.least("n", "other_n") / 40)
    return pairs.groupBy("gid", "other_gid", "n", "other_n").agg(F.count("*").alias("shared")).where(
        F.col("shared") >= enough).select("gid", "other_gid")


def _shared_postings(prefixes, seen):
    """Stored (shingle, gid, n, place) of the groups, without most shingles that one group alone has.

    ``seen`` holds every shingle that several have.
    """
    layout = "shingle bigint, gid bigint, n bigint, place int"
    common = _BitMap(seen, "shingle", _SHINGLE_BITS)

    def pick(batches):
        for batch in batches:
            lists = batch.column(2)
            found, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = common.may_hold(found)
            of = [batch.column(i).to_numpy()[row[kept]] for i in range(2)]
            yield pa.RecordBatch.from_arrays([pa.array(found[kept]), *map(pa.array, of), pa.array(place[kept].astype(np.int32))],
                                             names=["shingle", "gid", "n", "place"])

    return stored(prefixes.select("gid", "n", "prefix").mapInArrow(pick, layout).distinct(), "postings")


def _texts(docs, wanted):
    """(key_a, key_b, text) of the wanted rows, one each."""
    near_by = _BitMap(wanted, "key_a", _TEXT_BITS)

    def pick(batches):
        for batch in batches:
            yield batch.filter(pa.array(near_by.may_hold(batch.column(0).to_numpy())))

    near = docs.select(*row_keys(), "text").mapInArrow(pick, "key_a bigint, key_b bigint, text string")
    return near.join(wanted, KEYS, "left_semi").dropDuplicates(KEYS)


def _with_texts(docs, pairs, owners):
    """The pairs (a, b, any other columns) with a_text and b_text, the texts of one owner of each set key."""
    pairs = stored(pairs.distinct(), "pairs")
    involved = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct().join(owners, "set_key")
    involved = stored(involved.select("set_key", "owner.*"), "owners")
    texts = stored(_texts(docs, involved.select(*KEYS)).join(involved, KEYS).select("set_key", "text"), "texts")
    return pairs.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")


def _linked(docs, pairs, owners, size, percent):
    """The pairs (a, b) of set keys whose sets are alike; exact, on the texts of one owner each."""
    def compare(batches):
        for batch in batches:
            kept = []
            for _, _, left, right in _rows(batch):
                x, y = shingles(left, size), shingles(right, size)
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.filter(pa.array(kept, pa.bool_())).select([0, 1])

    both = _with_texts(docs, pairs, owners).select("a", "b", "a_text", "b_text")
    return stored(both.mapInArrow(compare, "a binary, b binary"), "links")


def _differences(docs, members, owners, size, percent):
    """Stored (a, b, label, n, near, apart) of classes a with leaders b.

    ``apart`` holds the shingles that only one of the two has; ``near`` tells
    whether they link, ``n`` is the size of a.
    """
    layout = "a binary, b binary, label binary, n bigint, near boolean, apart array<bigint>"

    def compare(batches):
        for batch in batches:
            out = []
            for a, b, label, left, right in _rows(batch):
                x, y = shingles(left, size), shingles(right, size)
                apart = np.setxor1d(x, y, assume_unique=True)
                either = (len(x) + len(y) + len(apart)) // 2
                out.append((a, b, label, len(x), 100 * (either - len(apart)) >= percent * either, apart.view(np.int64)))
            yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    both = _with_texts(docs, members, owners).select("a", "b", "label", "a_text", "b_text")
    return stored(both.mapInArrow(compare, layout), "differences")


def _alike_by_difference(found, percent):
    """Pairs (a, b) of classes with one leader and different labels that may link.

    Classes of n and m shingles link if at most (n + m) (100 - percent) / (100 +
    percent) are in one of them alone. So their differences, of d and e, share
    half of what d + e is above that; it is one at least unless both link with
    the leader, and then they need not be compared.
    """
    apart, whole = 100 - percent, 100 + percent
    each = found.select("a", "b", "label", "n", "near", F.size("apart").alias("d"), F.explode("apart").alias("element"))
    times = each.groupBy("b", "element").agg(F.count("*").alias("times")).where("times > 1")
    held = each.join(times, ["b", "element"]).groupBy("a", "b", "label", "n", "near", "d").agg(  # a group is one class
        F.array_sort(F.collect_list(F.struct("times", "element"))).alias("held"))
    first = held.select("*", F.posexplode("held").alias("at", "next")).select(
        "b", F.col("next.element").alias("element"), "a", "label", "n", "near", "d", (F.col("d") - F.size("held") + F.col("at")).alias("place"))
    # Nothing that links is larger than n * 100 / percent, so beyond this place no common element comes first.
    first = stored(first.where(F.col("place") * percent * whole <= F.col("n") * (percent + 100) * apart), "differing")
    other = first.toDF("b", "element", *[f"other_{c}" for c in first.columns[2:]])
    small, large = F.least("n", "other_n"), F.greatest("n", "other_n")
    least = F.ceil((whole * (F.col("d") + F.col("other_d")) - apart * (F.col("n") + F.col("other_n"))) / F.lit(2.0 * whole))
    pairs = first.join(other, ["b", "element"]).where(F.col("a") < F.col("other_a")).where(F.col("label") != F.col("other_label"))
    pairs = pairs.where(~(F.col("near") & F.col("other_near"))).where(100 * small >= percent * large)
    pairs = pairs.where(F.least(F.col("d") - F.col("place"), F.col("other_d") - F.col("other_place")) >= least)
    return pairs.select("a", F.col("other_a").alias("b"))


def connected(links):
    """(node, label): the smallest node that links lead to, for every node of a link.

    Labels pass along links and are then looked up in themselves, until none
    changes; each round is stored.
    """
    ends = stored(links.union(links.select("b", "a")).distinct(), "ends")
    labels = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("label")), "labels")
    while True:
        heard = ends.join(labels.toDF("b", "heard"), "b").groupBy(F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        heard = stored(labels.join(heard, "node").select("node", F.least("label", "heard").alias("next"), "label"), "heard")
        ahead = heard.select(F.col("node").alias("next"), F.col("next").alias("ahead"))
        after = heard.join(ahead, "next").select("node", F.least("next", "ahead").alias("label"), (F.col("label") != F.least("next", "ahead")).alias("new"))
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.where("new").isEmpty():
            return labels


def near_duplicates(docs, size=5, percent=80):
    """Rows key_a, key_b, doc_id, n_shingles, component_id and kept.

    Two documents link if 100 times the shingles they share is at least
    ``percent`` times those that either has. ``component_id`` is the smallest
    id reachable by links, itself included. ``kept`` holds for rows of one id
    and text in each component, the smallest id's, and for empty sets.
    """
    digests = _digests(docs, size, percent)
    rows = digests.where(F.col("set_key").isNotNull()).select("key_a", "key_b", "doc_id", "n", "set_key")
    frequent = digests.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("times").alias("times"))
    sets = digests.where(F.col("least").isNotNull()).select("set_key", "n", "least", "key_a")
    seen = stored(_counted_in(sets, 1), "seen")
    counted = stored(frequent.select("shingle", F.greatest("times", F.lit(_PREFIX_SHARE + 1)).alias("times")).union(
        seen.where(F.col("times") > _PREFIX_SHARE)), "frequent")
    order = _Order(counted)
    whole = _whole_sets(docs, _unsettled(sets, percent, order), size)
    order = _Order(stored(counted.union(_counted_in(whole, _PREFIX_SHARE)), "frequent"))
    # That more shingles are known as frequent may leave other sets with too few.
    left = _unsettled(sets, percent, order).join(whole, "set_key", "left_anti")
    whole = whole.union(_whole_sets(docs, left, size))
    from_texts = _prefixes(whole, percent, order)
    prefixes = _prefixes(sets, percent, order).union(from_texts)

    owners = rows.where("n > 0").groupBy("set_key").agg(
        F.min(F.struct("key_a", "key_b")).alias("owner"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key_a", "key_b")).alias("first"))
    owners = stored(owners, "set-owners")
    classes = stored(prefixes.select("set_key", "gid").distinct(), "classes")
    postings = _shared_postings(prefixes, seen.select("shingle").union(from_texts.select(F.explode("prefix"))))
    lists = stored(postings.groupBy("shingle").agg(F.count("*").alias("members")).where("members > 1"), "lists")
    shared = stored(postings.join(lists, "shingle"), "shared")

    # First round: each group against the leaders of its shingles, each class against the first of its group.
    # A shingle's leader is the group whose shingles have most members: the text that near copies were made of.
    central = stored(shared.groupBy("gid").agg((F.sum("members") / F.first("n")).alias("central")), "central")
    leaders = shared.join(central, "gid").groupBy("shingle").agg(F.max(F.struct("central", "gid", "n", "place")).alias("leader"))
    shared = shared.drop("members")
    leaders = stored(leaders, "leaders")
    led = shared.join(leaders, "shingle")
    other = {"gid": F.col("leader.gid"), "n": F.col("leader.n"), "place": F.col("leader.place")}
    pairs = led.where(F.col("gid") != other["gid"]).where(_fits(percent, F.col("n"), other["n"], F.col("place"), other["place"]))
    pairs = _counted(pairs.select("gid", "n", other["gid"].alias("other_gid"), other["n"].alias("other_n")))
    firsts = stored(classes.groupBy("gid").agg(F.min("set_key").alias("first"), F.count("*").alias("members")), "group-firsts")
    across = pairs.join(firsts.select("gid", F.col("first").alias("a")), "gid").join(
        firsts.select(F.col("gid").alias("other_gid"), F.col("first").alias("b")), "other_gid").select("a", "b")
    within = classes.join(firsts.where("members > 1"), "gid").where(F.col("set_key") != F.col("first")).select(
        F.col("first").alias("a"), F.col("set_key").alias("b"))
    links = _linked(docs, _ordered(across.union(within)), owners, size, percent)

    # Second round: members of different components.
    labels = connected(links)
    labelled = stored(classes.join(labels.toDF("set_key", "label"), "set_key", "left").select(
        "gid", "set_key", F.coalesce("label", "set_key").alias("label")), "labelled")
    spans = stored(labelled.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high")), "group-labels")
    marked = stored(shared.join(spans, "gid"), "marked")
    opened = stored(marked.groupBy("shingle").agg(F.min("low").alias("least"), F.max("high").alias("most"))
                    .where(F.col("least") != F.col("most")).select("shingle"), "open-lists")
    # Groups of long lists, and those whose members lie apart, get a leader to differ from.
    hot = opened.join(lists.where(F.col("members") > _PREFIX_SHARE), "shingle").join(leaders, "shingle").select("shingle", "leader")
    led = marked.join(hot, "shingle").groupBy("gid").agg(F.max(F.struct("leader.central", "leader.gid"))["gid"].alias("lead"))
    apart = spans.where(F.col("low") != F.col("high")).select("gid")
    leads = led.join(apart, "gid", "full").select("gid", F.coalesce("lead", "gid").alias("lead"))
    leads = stored(leads, "group-leads")
    marked = stored(marked.join(opened, "shingle").join(leads, "gid", "left").select(
        "shingle", "gid", "n", "place", "low", "high", "lead"), "open-postings")
    second = marked.toDF("shingle", "other_gid", "other_n", "other_place", "other_low", "other_high", "other_lead")
    pairs = marked.join(second, "shingle").where(F.col("gid") < F.col("other_gid")).where(
        ~F.coalesce(F.col("lead") == F.col("other_lead"), F.lit(False))).where(
        ~((F.col("low") == F.col("high")) & (F.col("low") == F.col("other_low")) & (F.col("low") == F.col("other_high"))))
    pairs = _counted(pairs.where(_fits(percent, F.col("n"), F.col("other_n"), F.col("place"), F.col("other_place"))))
    a, b = labelled.toDF("gid", "a", "a_label"), labelled.toDF("other_gid", "b", "b_label")
    across = pairs.join(a, "gid").join(b, "other_gid").where(F.col("a_label") != F.col("b_label")).select("a", "b")
    members = labelled.join(leads, "gid").join(firsts.select(F.col("gid").alias("lead"), F.col("first").alias("b")), "lead").select(
        F.col("set_key").alias("a"), "b", "label").where(F.col("a") != F.col("b"))
    differences = _differences(docs, members, owners, size, percent)
    differing = _alike_by_difference(differences, percent)
    links = links.union(differences.where("near").select("a", "b")).union(
        _linked(docs, _ordered(across.union(differing)), owners, size, percent))

    labels = connected(links).toDF("set_key", "label")
    named = owners.join(labels, "set_key", "left").select("set_key", "first", F.coalesce("label", "set_key").alias("label"))
    components = named.groupBy("label").agg(F.min("first").alias("chosen"))
    of_sets = stored(named.join(components, "label").select("set_key", "chosen"), "components")
    found = rows.join(of_sets, "set_key", "left")
    same = (F.col("chosen.key_a") == F.col("key_a")) & (F.col("chosen.key_b") == F.col("key_b"))
    return found.select("key_a", "key_b", "doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("chosen.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                        ((F.col("n") == 0) | F.coalesce(same, F.lit(False))).alias("kept"))


def _ordered(pairs):
    return pairs.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def first_of_each(docs, size=5, percent=80):
    """The documents, all columns, that stay when one of each component does."""
    keyed = docs.select("*", *[k.alias(f"_near_{k_name}") for k, k_name in zip(row_keys(), KEYS)])
    kept = near_duplicates(docs, size, percent).where("kept").select(
        F.col("key_a").alias("_near_key_a"), F.col("key_b").alias("_near_key_b"), "n_shingles").distinct()
    kept = kept.withColumnRenamed("n_shingles", "_near_n")
    names = ["_near_key_a", "_near_key_b"]
    alone = F.when(F.col("_near_n") == 0, F.monotonically_increasing_id()).alias("_near_row")
    joined = keyed.join(kept, names).select("*", alone)
    return joined.dropDuplicates([*names, "_near_row"]).select(*[F.col(f"`{c}`") for c in docs.columns])
