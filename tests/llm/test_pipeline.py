import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridecells.llm import quality
from ridecells.llm.secrets import RULES
from tests.llm.helpers import documents
from tests.llm.test_decontamination import words
from tests.llm.test_jaccard import expected as components
from tests.llm.test_packing import whole
from tests.llm.helpers import VOCABULARY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before the first stage and after each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return [[r.asDict() for r in frame.collect()] for frame in out], [frame.dtypes for frame in out]


def test_stages_keep_the_columns(stages):
    assert all(kinds == stages[1][0] for kinds in stages[1][:-1])


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_rejected_documents_go(spark, stages):
    rows, _ = stages
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.train(quality.document_statistics(frame), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    for r in rows[0]:
        good = model.score([quality.statistics(r["text"])])[0] >= quality.THRESHOLD
        assert (r["doc_id"] in by_id(rows[1])) == good
    assert all(by_id(rows[0])[r["doc_id"]] == r for r in rows[1])


def test_one_of_each_group_stays(stages):
    rows, _ = stages
    labels = components([r["text"] for r in rows[1]], [r["doc_id"] for r in rows[1]], 5, 80)
    assert sorted(r["doc_id"] for r in rows[2]) == sorted({c for _, _, c in labels})
    assert len(rows[2]) < len(rows[1])


def test_contaminated_documents_go(spark, stages):
    rows, _ = stages
    windows = set()
    for item in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(item.text)
        m = min(13, len(w))
        windows |= {tuple(w[s:s + m]) for s in range(len(w) - m + 1) if m}
    sizes = {len(w) for w in windows}
    kept = []
    for r in rows[2]:
        w = words(r["text"])
        hit = {q for m in sizes for p in range(len(w) - m + 1) if tuple(w[p:p + m]) in windows for q in range(p, p + m)}
        if not hit or 20 * len(hit) < len(w):
            kept.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(kept)


def test_secrets_are_masked(stages):
    rows, _ = stages
    assert len(rows[4]) == len(rows[3])
    for r in rows[3]:
        covered = set()
        for rule in RULES:
            covered |= {i for m in re.finditer(rule.regex, r["text"]) if len(m[rule.group]) >= rule.least for i in range(m.start(), m.end())}
        own = by_id(rows[4])[r["doc_id"]]
        assert own["n_chars"] == len(own["text"])
        assert own["text"].replace("[secret]", "") == "".join(c for i, c in enumerate(r["text"]) if i not in covered).replace("[secret]", "")


def test_all_remaining_tokens_are_packed(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rows, _ = stages
    lengths = {r["doc_id"]: len(whole(library, r["text"])) + 1 for r in rows[4]}
    found = {}
    for r in rows[5]:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == lengths


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).count() == len(stages[0][5])


@pytest.mark.parametrize("texts, ids", [([], []), ([None, "", "", "same text here", "same text here"], [None, 1, 1, 2, 2])])
def test_odd_tables(spark, texts, ids):
    docs = documents(spark, texts, ids).withColumn("secrets", F.lit(1)).withColumn("n", F.lit(2)).withColumn("key_a", F.lit(3))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.dtypes == docs.dtypes
        docs = after
    assert docs.count() == (4 if texts else 0)
    assert corpus_pipeline.packed(spark, docs, FOLDER).count() == (4 if texts else 0)
    kept = corpus_pipeline.good_quality(spark, documents(spark, texts, ids), FOLDER)
    assert kept.dtypes == documents(spark, []).dtypes and kept.count() <= len(texts)
