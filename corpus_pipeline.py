"""Documents to training sequences: five stages, each on what the one before kept.

1. Quality: documents that the classifier rejects go.
2. Near duplicates on five-word shingles, similarity 0.8: one of each group stays.
3. Benchmark contamination: documents with a twentieth of their words or more in passages go.
4. Secrets are masked; no document goes.
5. The remaining texts are cut into pieces of tokens and packed into sequences.

Stages 1 to 4 return the columns of ``documents``. Nulls, empty texts, repeated
rows and empty tables have the results that the operators state.
"""

import public_tokenizers

from ridecells.llm import decontamination, jaccard, packing, quality, secrets
from ridecells.llm.common import stored

VOCABULARY = "word_bpe_49k.json"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark, docs, sf_dir):
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    return jaccard.first_of_each(docs, size=5, percent=80)


def decontaminated(spark, docs, sf_dir):
    return decontamination.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def masked_secrets(spark, docs, sf_dir):
    return secrets.without_secrets(docs)


def packed(spark, docs, sf_dir):
    pieces = packing.token_pieces(docs, public_tokenizers.path(VOCABULARY), with_ids=False)
    return packing.pack(pieces)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scan", masked_secrets),
    ("best-fit packing", packed),
]

#: Scores of fitted trees and token ids aren't SQL; tests/llm/test_pipeline.py checks the stages.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over all documents; each stage's rows are stored."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
