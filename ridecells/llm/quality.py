"""Text quality by gradient-boosted trees over document statistics.

Statistics come from the whole text alone, one pass of numpy over its bytes and
a pass over its words and lines. Trees are fitted by Spark's distributed
histogram learner on all labelled rows that are not held out; nothing is
sampled. The fitted trees are read into flat arrays (feature, threshold, left,
right, value) and walked for all rows and trees at once.

A null or empty text has statistics of zero and a score like any other. Rows
whose label is null are not learned from; several labels of one id count as
their mean, 1 from a half on. Without labels, or with labels of one kind only,
every score is the share of ones (a half without any). No documents give no rows.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema, stored
from ridecells.session import shared_folder

TREES = 30
DEPTH = 4
BINS = 64
STEP = 0.2
SEED = 7
#: Predicted 1 from this score on.
THRESHOLD = 0.7
#: Rows of a batch whose texts are held beside it at once.
_ROWS_AT_ONCE = 256

STATISTICS = [
    "log_chars", "upper", "digits", "spaces", "lines", "marks", "odd_signs", "beyond_ascii", "byte_entropy",
    "log_words", "word_length", "distinct_words", "top_word", "words_shouting", "words_ending_odd", "longest_word",
    "log_lines", "line_length", "repeated_lines", "top_line", "table_signs", "braces", "shortest_line_share", "repeated_words",
]

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "spaces": b" \t", "lines": b"\n", "marks": b".,;:?'\"()",
    "odd_signs": b"!#$%&*+<=>@^_`~\\/", "table_signs": b"|", "braces": b"{}[]",
}


def statistics(text):
    """The text's numbers, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    share = {k: float(counts[np.frombuffer(signs, np.uint8)].sum()) / n for k, signs in _KINDS.items()}
    seen = counts[counts > 0] / n
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    distinct, distinct_lines = Counter(words), Counter(lines)
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    longest = max(map(len, words), default=0)
    shouting = sum(times for word, times in distinct.items() if len(word) > 1 and word.isupper())
    odd = sum(times for word, times in distinct.items() if not (word[-1:].isalnum() or word[-1] in b".,;:?'\")" or word[-1] > 127))
    repeated = sum(len(line) * (times - 1) for line, times in distinct_lines.items())
    return [
        np.log1p(len(text)), share["upper"], share["digits"], share["spaces"], share["lines"], share["marks"], share["odd_signs"],
        float(counts[128:].sum()) / n, float(-(seen * np.log2(seen)).sum()),
        np.log1p(len(words)), sum(map(len, words)) / n_words, len(distinct) / n_words, max(distinct.values(), default=0) / n_words,
        shouting / n_words, odd / n_words, np.log1p(longest),
        np.log1p(len(lines)), n / n_lines, repeated / n, max(distinct_lines.values(), default=0) / n_lines,
        share["table_signs"], share["braces"], sum(len(line) < 20 for line in lines) / n_lines,
        sum(times - 1 for times in distinct.values()) / n_words,
    ]


def _slices(batches):
    """The rows of the batches, few at a time, so that their texts aren't all held twice."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(at, _ROWS_AT_ONCE)


def document_statistics(docs):
    """Stored rows doc_id, held_out and features, one per document row."""
    layout = "doc_id bigint, held_out boolean, features array<double>"

    def measure(batches):
        for batch in _slices(batches):
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield arrow_batch([(doc_id, is_held_out(doc_id), statistics(text)) for doc_id, text in rows], schema)

    schema = arrow_schema(layout)
    return stored(docs.select("doc_id", "text").mapInArrow(measure, layout), "statistics")


def is_held_out(doc_id):
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id does not."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


class FlatTrees:
    """Boosted trees as arrays; ``margin`` walks all of them for all rows at once.

    ``trees`` are lists of (id, feature, threshold, left, right, value), children
    after their parents; a leaf has a left child of -1.
    """

    def __init__(self, trees, weights):
        shape = (len(trees), max(len(t) for t in trees))
        self.feature, self.threshold, self.value = np.zeros(shape, np.int32), np.full(shape, np.inf), np.zeros(shape)
        self.left, self.right = np.tile(np.arange(shape[1]), (2, len(trees), 1))  # a leaf leads to itself
        self.weights, self.depth = np.asarray(weights, float), 0
        for t, nodes in enumerate(trees):
            levels = {0: 0}
            for i, feature, threshold, left, right, value in sorted(nodes):
                self.value[t, i] = value
                if left >= 0:
                    self.feature[t, i], self.threshold[t, i] = feature, threshold
                    self.left[t, i], self.right[t, i] = left, right
                    levels[left] = levels[right] = levels[i] + 1
            self.depth = max(self.depth, *levels.values())

    def margin(self, features):
        features = np.asarray(features, float)
        trees = np.arange(len(self.weights))[None, :]
        rows = np.arange(len(features))[:, None]
        at = np.zeros((len(features), len(self.weights)), np.int64)
        for _ in range(self.depth):
            below = features[rows, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(below, self.left[trees, at], self.right[trees, at])
        return self.value[trees, at] @ self.weights

    def score(self, features):
        """Between 0 and 1; twice the margin is the log odds."""
        return 1 / (1 + np.exp(-2 * self.margin(features))) if len(features) else np.zeros(0)


class Constant:
    """The score of every row where nothing can be learned."""

    def __init__(self, share):
        self.share = share

    def score(self, features):
        return np.full(len(features), self.share)


def flat_trees(spark, model):
    """A fitted Spark model's trees as arrays, read from its saved nodes."""
    folder = shared_folder(spark, "quality-model")
    model.save(folder)
    saved = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").collect()  # trees times nodes, bounded by their depth
    trees = [[] for _ in range(len(model.treeWeights))]
    for r in saved:
        at = (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0]
        trees[r["treeID"]].append((r["id"], r["split"]["featureIndex"], at, r["leftChild"], r["rightChild"], r["prediction"]))
    return FlatTrees(trees, model.treeWeights)


def train(features, labels, trees=TREES, depth=DEPTH):
    """The classifier of ``labels.quality``, from rows that are not held out."""
    # Imported here, since tasks that measure and score load this module but learn nothing.
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("double").alias("label"))
    known = features.where(~F.col("held_out")).join(own, "doc_id")
    known = stored(known.select("label", "features"), "labelled")
    share, n = known.agg(F.avg("label"), F.count("*")).first()
    if share in (None, 0.0, 1.0):
        return Constant(0.5 if share is None else share)
    learner = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=BINS, stepSize=STEP, seed=SEED, minInstancesPerNode=5)
    return flat_trees(features.sparkSession, learner.fit(known.select("label", array_to_vector("features").alias("features"))))


def scored(features, model):
    """doc_id, held_out, score and predicted for stored statistics."""
    layout = "doc_id bigint, held_out boolean, score double, predicted int"

    def score(batches):
        for batch in batches:
            numbers = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
            found = model.score(numbers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return features.mapInArrow(score, layout)


def classify(docs, labels):
    """doc_id, held_out, score and predicted of every document."""
    features = document_statistics(docs)
    return scored(features, train(features, labels))


def accepted(docs, labels, least=THRESHOLD):
    """The documents, all columns, whose score is ``least`` or more.

    The model decides on the text alone, so texts are scored where they lie and
    rows needn't be matched with scores.
    """
    model, names = train(document_statistics(docs), labels), docs.columns

    def keep(batches):
        for batch in _slices(batches):
            numbers = [statistics(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(model.score(np.array(numbers).reshape(len(numbers), -1)) >= least, pa.bool_())).select(names)

    return docs.mapInArrow(keep, docs.schema)
