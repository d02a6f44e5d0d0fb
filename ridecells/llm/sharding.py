"""Shards of near equal bytes from a k-d tree over document metadata.

The root is to become as many shards as its bytes hold targets. A node of
several shards is split across the dimension in which it is widest, as a share
of the whole table's width, at the weighted median: the left side takes its
part of the shards' bytes, to within one row. Rows of one value are told apart
by a hash of id and text, so a value that many rows share is split like any
other; repeated rows stay together. Leaves, of the target bytes, are shards.

Medians are found over the cluster, for all nodes of a level at once: bytes are
summed in ``_SLOTS`` slots of each node's interval, then in slots of the slot
in which the left side fills up, until that is one value. The driver keeps one
interval per node, so at most one per shard. Texts are read once; a level costs
some small aggregations over sizes, dimensions and hashes, and rows are not
shuffled.

Null texts and empty ones have a size of 1 and a checksum of 0. Null dimensions
count as zero. No documents give no rows. Other columns are not read.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridecells.llm.common import stored

_SLOTS = 4096
_TIE_BITS = 36
_ROWS_A_PLACE = 2000


def _numbered(name):
    """A text column as whole numbers, equal for equal texts."""
    return F.crc32(F.coalesce(F.col(name), F.lit("")))


def document_dimensions():
    """Dimensions of documents, as whole-number columns."""
    return {"size": F.octet_length("text"), "source": _numbered("source"), "lang": _numbered("lang"), "doc_id": F.col("doc_id")}


def _frame(spark, rows, layout):
    return F.broadcast(spark.createDataFrame(rows, layout))  # one row a node, at most one a shard


def _filled(rows, key, nodes):
    """For each node the key at which the wanted bytes are reached: node to (key, bytes before it).

    ``rows`` has node, size and the key. ``nodes`` maps a node to (low, high,
    want): all its keys lie in that interval, and hold the wanted bytes.
    """
    spark, found, left = rows.sparkSession, {}, {k: (*v, 0) for k, v in nodes.items()}
    while left:
        steps = {k: max(1, -(-(high - low + 1) // _SLOTS)) for k, (low, high, _, _) in left.items()}
        frame = _frame(spark, [(k, low, high, steps[k], want - before) for k, (low, high, want, before) in left.items()],
                       "node int, low bigint, high bigint, step bigint, want bigint")
        inside = rows.join(frame, "node").where(F.col(key).between(F.col("low"), F.col("high")))
        sums = inside.groupBy("node", "want", F.expr(f"({key} - low) DIV step").alias("slot")).agg(F.sum("size").alias("bytes"))
        # at most _SLOTS rows a node
        reached = sums.select("*", F.sum("bytes").over(Window.partitionBy("node").orderBy("slot")).alias("reached"))
        full = reached.where("reached >= want").groupBy("node").agg(F.min(F.struct("slot", "reached", "bytes")).alias("first"))
        for k, (slot, upto, own) in full.collect():
            low, high, want, before = left.pop(k)
            low, before = low + slot * steps[k], before + upto - own
            if steps[k] == 1:
                found[k] = (low, before)
            else:
                left[k] = (low, min(high, low + steps[k] - 1), want, before)
    return found


def _split(rows, names, nodes, stats, whole):
    """(frame of cuts, shards of the new nodes) for the nodes of several shards."""
    chosen = {}
    for k, shards in nodes.items():
        if shards > 1 and k in stats:
            width = {n: (stats[k][f"{n}_high"] - stats[k][f"{n}_low"]) / max(1, whole[f"{n}_high"] - whole[f"{n}_low"]) for n in names}
            widest = max(names, key=width.get)
            chosen[k] = (widest, stats[k][f"{widest}_low"], stats[k][f"{widest}_high"], stats[k]["bytes"] * (shards // 2) // shards)
    if not chosen:
        return None, nodes
    spark = rows.sparkSession
    dims = _frame(spark, [(k, names.index(v[0])) for k, v in chosen.items()], "node int, dim int")
    valued = rows.join(dims, "node").select("node", "size", "tie", F.get(F.array(*names), F.col("dim")).alias("value"))
    cuts = _filled(valued, "value", {k: (low, high, max(1, want)) for k, (_, low, high, want) in chosen.items()})
    at = _frame(spark, [(k, cuts[k][0]) for k in chosen], "node int, at bigint")
    level = valued.join(at, "node").where("value = at")
    ties = _filled(level, "tie", {k: (0, (1 << _TIE_BITS) - 1, max(1, chosen[k][3]) - cuts[k][1]) for k in chosen})
    cut = [(k, names.index(chosen[k][0]), cuts[k][0], ties[k][0]) for k in chosen]
    after = {k: v for k, v in nodes.items() if k not in chosen}
    for k in chosen:
        after[2 * k], after[2 * k + 1] = nodes[k] // 2, nodes[k] - nodes[k] // 2
    return _frame(spark, cut, "node int, dim int, at bigint, tie_at bigint"), after


def kd_shards(docs, shards=None, target_bytes=None, dimensions=None):
    """(doc_id, size, text_crc32, shard, slot): every document in a shard.

    Give the number of shards, or the bytes that each is to reach. Size is the
    text's UTF-8 bytes and one more. Slots number a shard's rows from 0, without
    gaps. Fewer rows than shards leave shards empty.
    """
    dimensions = dimensions or document_dimensions()
    names = [f"dim_{i}" for i in range(len(dimensions))]
    dims = [F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in zip(names, dimensions.values())]
    rows = stored(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - _TIE_BITS).alias("tie"), *dims, F.lit(1).alias("node")), "sizes")

    bounds = [f(n).alias(f"{n}_{end}") for n in names for f, end in ((F.min, "low"), (F.max, "high"))]
    whole = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *bounds).first()
    shards = shards or max(1, -(-(whole["bytes"] or 0) // target_bytes))
    nodes = {1: shards}
    while any(n > 1 for n in nodes.values()):
        stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *bounds).collect()}
        cuts, nodes = _split(rows, names, nodes, stats, whole)
        if cuts is None:
            break
        value = F.get(F.array(*names), F.col("dim"))
        left = (value < F.col("at")) | ((value == F.col("at")) & (F.col("tie") <= F.col("tie_at")))
        moved = F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 0).otherwise(1))
        rows = stored(rows.join(cuts, "node", "left").select(
            "doc_id", "size", "text_crc32", "tie", *names, moved.cast("int").alias("node")), "nodes")
    order, numbers = sorted(nodes, key=lambda k: k / (1 << k.bit_length())), {}
    for k in order:
        numbers[k] = sum(nodes[o] for o in numbers)
    leaves = _frame(docs.sparkSession, [(k, s) for k, s in numbers.items()], "node int, shard int")
    return _numbered_slots(rows.join(leaves, "node").drop("node", *names), shards, whole["n"])


def _numbered_slots(rows, shards, n):
    """Rows with a gapless slot in their shard: places of some rows, their sums, then numbers within."""
    places = max(1, n // (shards * _ROWS_A_PLACE))
    placed = rows.select("*", F.pmod("tie", F.lit(places)).alias("place"))
    earlier = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "place").agg(F.count("*").alias("n")).select(
        "shard", "place", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "place").orderBy("doc_id", "tie")
    numbered = placed.select("*", (F.row_number().over(inside) - 1).alias("nth"))
    return numbered.join(starts, ["shard", "place"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth")).alias("slot"))
