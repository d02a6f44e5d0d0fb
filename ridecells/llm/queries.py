"""The operators of this folder over the given tables, and SQL that checks them."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from ridecells.llm import decontamination, fingerprints, jaccard, main_text, packing, quality, ranking, runs, secrets, sharding, sql, token_counts, token_files, warc
from ridecells.llm.common import stored

VOCABULARY = "word_bpe_49k.json"
NEAR_WORDS = 2


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed_documents(spark, folder):
    pieces = packing.token_pieces(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False)
    return packing.pack(pieces)


def token_id_files(spark, folder):
    docs = _table(spark, folder, "documents")
    manifest, files = token_files.write_documents(docs, public_tokenizers.path(VOCABULARY), end_id=1)
    return token_files.read_files(manifest, files, with_ids=False)


def secret_scan(spark, folder):
    found = secrets.find_secrets(_table(spark, folder, "documents"))
    base = F.filter("secrets", lambda s: s["rank"] < len(secrets.BASE))
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, r.kind))).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("secrets")).alias("spans"))


def order_minhash_fingerprints(spark, folder):
    return fingerprints.compared_with_edits(_table(spark, folder, "documents"))


def zipped_warc(spark, folder):
    manifest, archives = warc.write_archives(_table(spark, folder, "pages"))
    return warc.read_archives(manifest, archives, with_payload=False)


def kd_tree_shards(spark, folder):
    return sharding.kd_shards(_table(spark, folder, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def ngram_jaccard_join(spark, folder):
    return jaccard.near_duplicates(_table(spark, folder, "documents"), size=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


def quality_classifier(spark, folder):
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def benchmark_decontamination(spark, folder):
    """Exact phrases, and beside them the items whose rarest words stand in a document up to ``NEAR_WORDS`` words off."""
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), NEAR_WORDS)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        "contaminated", "n_near", F.sha2(F.array_join("near_ids", ","), 256).alias("near_sha256"))


def edited_token_counts(spark, folder):
    """Each document with three edits of its own text: a new start, its first words repeated in the middle, a gap at a quarter.

    The trees are built and stored first; the edits then start from what was stored.
    """
    vocabulary = public_tokenizers.path(VOCABULARY)
    docs = stored(token_counts.count_trees(_table(spark, folder, "documents"), vocabulary), "count-trees")
    size = F.coalesce(F.char_length("text"), F.lit(0))
    half, quarter = F.floor(size / 2), F.floor(size / 4)
    edits = F.array(
        token_counts.change(F.lit(0), F.lit(8), F.lit("Edited text, ")),
        token_counts.change(half, half, F.substring("text", 1, 64)),
        token_counts.change(quarter, quarter + 32, F.lit("")))
    return token_counts.edited(docs, edits, vocabulary)


def extracted_main_text(spark, folder):
    return main_text.main_text(_table(spark, folder, "pages"))


def periodic_runs(spark, folder):
    return runs.run_digests(_table(spark, folder, "documents"))


def ranked_search(spark, folder):
    return ranking.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    "op1_best_fit_packing": (packed_documents, None),
    "op2_trigram_secret_scan": (secret_scan, sql.secret_scan(secrets.RULES, len(secrets.BASE))),
    "op3_order_minhash": (order_minhash_fingerprints, None),
    "op4_zipped_warc": (zipped_warc, None),
    "op5_ngram_jaccard_join": (ngram_jaccard_join, sql.JACCARD),
    "op6_kd_tree_shards": (kd_tree_shards, None),
    "op7_quality_trees": (quality_classifier, None),
    "op8_token_id_files": (token_id_files, None),
    "op9_benchmark_decontamination": (benchmark_decontamination, sql.decontamination(decontamination.ANCHORS, NEAR_WORDS)),
    "op10_edited_token_counts": (edited_token_counts, None),
    "op11_main_text": (extracted_main_text, None),
    "op12_periodic_runs": (periodic_runs, None),
    "op13_pair_bound_search": (ranked_search, sql.RANKING),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
