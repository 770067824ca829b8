"""The queries of this package, by name, and SQL for those that SQL can state."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, fingerprints, lm, packing, quality, simhash, suffix_dedup, topk, toxicity, warc
from .common import documents


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_repeats(spark, sf_dir):
    return suffix_dedup.repeats(documents(spark, sf_dir))


def op2_warc_revisits(spark, sf_dir):
    return warc.deduplicated(_table(spark, sf_dir, "pages"))


def op2_archive_round_trip(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_exact_top_k(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op4_deleted_interpolation(spark, sf_dir):
    return lm.scores(documents(spark, sf_dir))


def op5_toxic_clauses(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.toxic_documents(docs, toxicity.learned_insults(docs, _table(spark, sf_dir, "labels")))


def op6_threshold_sketches(spark, sf_dir):
    return fingerprints.fingerprints(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op6_benchmark_passages(spark, sf_dir):
    return fingerprints.passages(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op7_quality_scores(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.scores(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op8_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_curve_packing(spark, sf_dir):
    return packing.packs(documents(spark, sf_dir))


def op10_forced_boundary_bpe(spark, sf_dir):
    return bpe.encoded(documents(spark, sf_dir))


QUERIES = {
    "op1_suffix_array_repeats": op1_suffix_array_repeats,
    "op2_warc_revisits": op2_warc_revisits,
    "op2_archive_round_trip": op2_archive_round_trip,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_deleted_interpolation": op4_deleted_interpolation,
    "op5_toxic_clauses": op5_toxic_clauses,
    "op6_threshold_sketches": op6_threshold_sketches,
    "op6_benchmark_passages": op6_benchmark_passages,
    "op7_quality_scores": op7_quality_scores,
    "op8_simhash_near_duplicates": op8_simhash_near_duplicates,
    "op9_curve_packing": op9_curve_packing,
    "op10_forced_boundary_bpe": op10_forced_boundary_bpe,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {"op6_threshold_sketches": fingerprints.sql(), "op6_benchmark_passages": fingerprints.passages_sql(), "op2_warc_revisits": warc.sql(), "op2_archive_round_trip": warc.round_trip_sql(), "op3_exact_top_k": topk.sql()}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
