import subprocess
import sys
import zlib

import numpy as np
import pytest

from ridecells.llm import quality
from ridecells.llm.quality import THRESHOLD, STATISTICS, FlatTrees, accepted, classify, document_statistics, statistics, train
from tests.llm.helpers import LONG, ODD_TEXTS, documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def found(tables):
    return [r.asDict() for r in classify(*tables).collect()]


def test_held_out_rows_are_told_apart(tables, found):
    assert len(found) == tables[0].count()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= THRESHOLD)
    labels = {r.doc_id: r.quality for r in tables[1].collect()}
    kept = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, q, _ in kept if q], [s for s, q, _ in kept if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([p == q for _, q, p in kept]) > 0.95


def test_held_out_labels_are_not_learned(spark, tables):
    from pyspark.sql import functions as F

    docs, labels = tables
    features = document_statistics(docs)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = np.array([r.features for r in features.limit(100).collect()])
    assert (train(features, labels, 3, 2).score(rows) == train(features, turned, 3, 2).score(rows)).all()


def plain_walk(tree, row):
    nodes, at = {n[0]: n for n in tree}, 0
    while nodes[at][3] >= 0:
        _, feature, threshold, left, right, _ = nodes[at]
        at = left if row[feature] <= threshold else right
    return nodes[at][5]


def test_flat_trees_against_a_plain_walk():
    rng = np.random.default_rng(2)
    trees = []
    for t in range(4):
        nodes, waiting, last = [], [(0, 0)], 0
        while waiting:
            i, level = waiting.pop(0)
            if level < t and rng.random() < 0.8:
                nodes.append((i, int(rng.integers(3)), float(rng.random()), last + 1, last + 2, 0.0))
                waiting += [(last + 1, level + 1), (last + 2, level + 1)]
                last += 2
            else:
                nodes.append((i, 0, 0.0, -1, -1, float(rng.normal())))
        trees.append(nodes)
    weights, rows = [1.0, 0.1, 0.2, 0.3], rng.random((50, 3))
    expected = [sum(w * plain_walk(t, r) for w, t in zip(weights, trees)) for r in rows]
    assert np.allclose(FlatTrees(trees, weights).margin(rows), expected)


def test_trees_of_spark_score_as_spark_does(spark, tables):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql import functions as F

    from ridecells.llm.quality import flat_trees

    frame = document_statistics(tables[0]).join(tables[1], "doc_id").select(
        F.col("quality").cast("double").alias("label"), "features", array_to_vector("features").alias("vector"))
    model = GBTClassifier(maxIter=3, maxDepth=3, featuresCol="vector").fit(frame)
    rows = model.transform(frame).select("features", vector_to_array("probability")[1].alias("p")).collect()
    assert np.allclose(flat_trees(spark, model).score([r.features for r in rows]), [r.p for r in rows])


def test_statistics_of_odd_texts():
    for text in ODD_TEXTS:
        numbers = statistics(text)
        assert len(numbers) == len(STATISTICS) and np.isfinite(numbers).all()
    assert statistics("AB cd\nAB cd")[STATISTICS.index("words_shouting")] == 0.5
    assert statistics("AB cd\nAB cd")[STATISTICS.index("repeated_lines")] == 5 / 11


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(0, 1), (1, 1)], 1.0), ([(0, None), (None, 0)], 0.5), ([(4, 0), (4, None)], 0.0)])
def test_labels_that_teach_nothing(spark, rows, labels, score):
    found = classify(documents(spark), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert rows(found, "doc_id", "score") == [(i, score) for i in range(len(ODD_TEXTS))]


def test_no_documents_null_ids_and_repeated_rows(spark, tables):
    labels = tables[1]
    assert classify(documents(spark, []), labels).collect() == []
    found = classify(documents(spark, [LONG, LONG, None], [None, 3, 3]), labels).collect()
    assert len(found) == 3 and not any(r.held_out for r in found if r.doc_id is None)


def test_rejected_documents_go(tables, found):
    kept = accepted(*tables)
    assert kept.columns == tables[0].columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r["doc_id"] for r in found if r["predicted"])


def test_tasks_load_no_learner():
    """A task imports the module to measure texts; Spark's learners would take 50 MB of each worker."""
    code = "import sys, ridecells.llm.quality; sys.exit('pyspark.ml' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0


def test_few_texts_are_held_beside_a_batch(spark, tables, monkeypatch):
    from pyspark.sql import functions as F

    docs, labels = tables
    whole = [r["doc_id"] for r in accepted(docs, labels).select("doc_id").orderBy("doc_id").collect()]
    frame = docs.withColumn("doc_id", F.col("doc_id"))
    seen = []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, work, layout: seen.append(work) or self)
    monkeypatch.setattr(quality, "document_statistics", lambda docs: None)
    monkeypatch.setattr(quality, "train", lambda features, labels: quality.Constant(1.0))
    accepted(frame, labels)
    monkeypatch.undo()
    batch = docs.limit(1000).toArrow().combine_chunks().to_batches()[0]
    parts = list(seen[0]([batch]))
    assert sum(p.num_rows for p in parts) == batch.num_rows == 1000
    assert max(p.num_rows for p in parts) <= 256
    assert parts[0].schema.names == docs.columns
    assert 0 < len(whole) < docs.count()
