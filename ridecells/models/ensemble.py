"""Tree ensembles as columns.

A small ensemble is the mean of nested ``when`` expressions: generated JVM code
in the middle of a plan, on batches and streams. Past ``MOST_TESTS`` tests such
an expression no longer fits generated code; then the trees are flat arrays,
walked for a batch of rows at once by numpy in a vectorised UDF. Both give the
same scores, by one rule for a test: it holds if the input is known and compares
so with the test's value. Null and NaN are unknown, and no test of them holds. A
field is compared as a number (a double) or, if its tests have text values, as
text. Where no branch holds, the tree and the mean are null.
"""

import xml.etree.ElementTree as xml
from collections import namedtuple

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

MOST_TESTS = 200

# A node is a leaf with a score, or a list of (test, node) tried in order. A
# test is (field, operator, value); None always holds.
Leaf = namedtuple("Leaf", "score")
Branches = namedtuple("Branches", "choices")
Ensemble = namedtuple("Ensemble", "trees categories")

_OPERATORS = {
    "equal": lambda a, b: a == b,
    "notEqual": lambda a, b: a != b,
    "lessThan": lambda a, b: a < b,
    "lessOrEqual": lambda a, b: a <= b,
    "greaterThan": lambda a, b: a > b,
    "greaterOrEqual": lambda a, b: a >= b,
}


def _known(field, text):
    """The field as its tests compare it; null where it is unknown."""
    return F.col(field).cast("string") if text else F.nanvl(F.col(field).cast("double"), F.lit(None).cast("double"))


def _holds(test):
    if test is None:
        return F.lit(True)
    field, operator, value = test
    text = isinstance(value, str)
    return _OPERATORS[operator](_known(field, text), F.lit(value if text else float(value)))


def tree_column(node):
    """Score of one tree; null when no branch holds, as for a null input."""
    if isinstance(node, Leaf):
        return F.lit(float(node.score))
    chain = F
    for test, child in node.choices:
        chain = chain.when(_holds(test), tree_column(child))
    return chain.otherwise(F.lit(None).cast("double"))


# Which signs of (input - value) an operator accepts, as bits for -1, 0 and 1.
_SIGNS = {"equal": 2, "notEqual": 5, "lessThan": 1, "lessOrEqual": 3, "greaterThan": 4, "greaterOrEqual": 6}


class FlatTrees:
    """Trees as arrays: a node's field, value, signs, next nodes and score.

    ``texts`` has the sorted values that tests of a text field use. Such a field
    is walked as a number: twice the place among them, plus one if it is one.
    """

    def __init__(self, trees, fields, texts):
        self.fields, self.texts, self.nodes, self.depth = list(fields), texts, [], 0
        self.nowhere = self._add(0, 0.0, 0, None, None, np.nan)
        self.roots = [self._flatten(tree, 0) for tree in trees]
        columns = zip(*self.nodes)
        self.field, self.value, self.signs, self.yes, self.no, self.score = map(np.array, columns)
        self.nodes = None

    def _add(self, field, value, signs, yes, no, score):
        here = len(self.nodes)
        self.nodes.append((field, value, signs, here if yes is None else yes, here if no is None else no, score))
        return here

    def _flatten(self, node, depth):
        self.depth = max(self.depth, depth)
        if isinstance(node, Leaf):
            return self._add(0, 0.0, 0, None, None, float(node.score))
        following, last = self.nowhere, len(node.choices) - 1
        for place in range(last, -1, -1):
            test, child = node.choices[place]
            below = self._flatten(child, depth + place + 1)
            if test is None:
                following = below
            else:
                field, operator, value = test
                value = 2 * self.texts[field].index(value) + 1 if field in self.texts else value
                following = self._add(self.fields.index(field), float(value), _SIGNS[operator], below, following, np.nan)
        return following

    def mean(self, inputs):
        """Mean score of each row; not a number where no branch holds, as for a null."""
        rows, total = np.arange(len(inputs)), np.zeros(len(inputs))
        for root in self.roots:
            at = np.full(len(inputs), root)
            for _ in range(self.depth + 1):
                own, value = inputs[rows, self.field[at]], self.value[at]
                sign = np.left_shift(1, 1 + (own > value).astype(np.int64) - (own < value))
                at = np.where(~np.isnan(own) & (self.signs[at] & sign > 0), self.yes[at], self.no[at])
            total = total + self.score[at]
        return total / len(self.roots)


def _flat_column(ensemble, texts):
    fields = sorted(set().union(*[_fields(tree) for tree in ensemble.trees]))
    flat = FlatTrees(ensemble.trees, fields or [""], texts)

    @F.pandas_udf("double")
    def mean(inputs: pd.DataFrame) -> pd.Series:
        scores = flat.mean(inputs.to_numpy(float))
        return pd.Series(scores).astype("Float64").mask(np.isnan(scores))

    def number(field):
        if field not in texts:
            return _known(field, False)
        values, own = F.array(*map(F.lit, texts[field])), _known(field, True)
        below = F.size(F.filter(values, lambda v: v < own))
        return F.when(own.isNotNull(), 2 * below + F.array_contains(values, own).cast("int")).cast("double")

    columns = [number(f).alias(f"f{i}") for i, f in enumerate(fields)]
    return mean(F.struct(*(columns or [F.lit(0.0).alias("f0")])))


def _tests(node):
    if isinstance(node, Leaf):
        return []
    return [test for test, _ in node.choices if test] + [t for _, child in node.choices for t in _tests(child)]


def _text_values(tests):
    """Text field to the sorted values of its tests."""
    texts, numbers = {}, set()
    for field, _, value in tests:
        if isinstance(value, str):
            texts.setdefault(field, set()).add(value)
        else:
            numbers.add(field)
    if texts.keys() & numbers:
        raise ValueError(f"compared as text and as numbers: {sorted(texts.keys() & numbers)}")
    return {field: sorted(values) for field, values in texts.items()}


def ensemble_column(ensemble):
    """Mean of the trees; null if a category has a value the model never saw."""
    tests = [t for tree in ensemble.trees for t in _tests(tree)]
    texts = _text_values(tests)
    if len(tests) > MOST_TESTS:
        mean = _flat_column(ensemble, texts)
    else:
        total = tree_column(ensemble.trees[0])
        for tree in ensemble.trees[1:]:
            total = total + tree_column(tree)
        mean = total / float(len(ensemble.trees))
    for field, values in ensemble.categories.items():
        mean = F.when(F.col(field).isin(list(values)), mean)
    return mean


def _local(element):
    return element.tag.rsplit("}", 1)[-1]


def _children(element, name):
    return [child for child in element if _local(child) == name]


def read_ensemble(spark, path):
    """Ensemble from a PMML document with averaged regression trees.

    The document is a model description of a few kilobytes to megabytes, read
    once where the plan is made.
    """
    files = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(files) != 1:
        raise ValueError(f"{path} holds {'no document' if not files else 'several documents'}")
    document = xml.fromstring(files[0]["value"])
    kinds, categories = {}, {}
    for field in document.iter():
        if _local(field) != "DataField":
            continue
        name = field.get("name")
        kinds[name] = {"integer": int, "string": str}.get(field.get("dataType"), float)
        values = [kinds[name](v.get("value")) for v in _children(field, "Value")]
        if values:
            categories[name] = tuple(values)

    def test_of(element):
        for child in element:
            if _local(child) == "True":
                return None
            if _local(child) == "SimplePredicate":
                field, text = child.get("field"), child.get("value")
                # A split point of an integer field may lie between integers.
                exact = kinds[field] is str or field in categories
                value = kinds[field](text) if exact else float(text)
                return field, child.get("operator"), value
        raise ValueError("a node without a simple predicate")

    def node_of(element):
        inner = _children(element, "Node")
        if not inner:
            return Leaf(float(element.get("score")))
        return Branches([(test_of(child), node_of(child)) for child in inner])

    for segmentation in document.iter():
        if _local(segmentation) != "Segmentation":
            continue
        if segmentation.get("multipleModelMethod") != "average":
            raise ValueError("only averaged trees are read")
        if any(not _children(s, "True") for s in _children(segmentation, "Segment")):
            raise ValueError("a segment that does not always hold")
    models = [m for m in document.iter() if _local(m) == "TreeModel"]
    trees = [
        Branches([(test_of(root), node_of(root))])
        for model in models for root in _children(model, "Node")
    ]
    used = {field for tree in trees for field in _fields(tree)}
    return Ensemble(trees, {f: v for f, v in categories.items() if f in used})


def _fields(node):
    if isinstance(node, Leaf):
        return set()
    own = {test[0] for test, _ in node.choices if test is not None}
    return own.union(*[_fields(child) for _, child in node.choices])


def ensemble_of_forest(spark, forest_model, path, features):
    """Ensemble of a fitted Spark ML forest with continuous features.

    The model is saved to ``path`` and its node table read back: one row per
    tree node, at most trees * 2 ** (depth + 1). A split by a set of categories
    is no threshold and is refused.
    """
    forest_model.write().overwrite().save(path)
    nodes = {}
    stored = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild",
        "nodeData.rightChild", "nodeData.split.featureIndex",
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("threshold"),
        F.col("nodeData.split.numCategories").alias("categories"),
    )
    for row in stored.collect():
        if row["leftChild"] >= 0 and row["categories"] >= 0:
            raise ValueError("a forest with categorical splits")
        nodes.setdefault(row["treeID"], {})[row["id"]] = row

    def build(tree, number):
        row = tree[number]
        if row["leftChild"] < 0:
            return Leaf(row["prediction"])
        field, split = features[row["featureIndex"]], float(row["threshold"][0])
        return Branches([
            ((field, "lessOrEqual", split), build(tree, row["leftChild"])),
            ((field, "greaterThan", split), build(tree, row["rightChild"])),
        ])

    return Ensemble([build(nodes[t], 0) for t in sorted(nodes)], {})


def ensemble_cuts(ensemble):
    """Field to the sorted numbers its tests compare it with; between them scores don't change."""
    cuts = {}
    for field, _, value in (t for tree in ensemble.trees for t in _tests(tree)):
        if isinstance(value, str):
            raise ValueError(f"{field} is compared as text")
        cuts.setdefault(field, set()).add(float(value))
    return {field: sorted(values) for field, values in cuts.items()}


def score_ensemble(ensemble, rows):
    """Rows with the column ``prediction``."""
    return rows.withColumn("prediction", ensemble_column(ensemble))
