"""One thin query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chunk_dedup, decontaminate, html_content, jaccard_join, langid, lattice_lm, packing, periodic_runs, pii, token_alignment, token_shards, toxicity, url_filter
from .common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified", "round")


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_documents(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(table(spark, sf_dir, "documents"))


def op5_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(table(spark, sf_dir, "documents"), token_shards.shard_folder(spark), seed=20240131)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_groups(table(spark, sf_dir, "documents"), k=3, percent=90, steps=3)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_best_fit_packing, op3_lattice_lm, op4_pii, op5_html_content, op6_chunk_dedup, op7_langid, op8_toxicity, op9_token_shards, op10_jaccard_join, op11_token_alignment, op12_url_filter, op13_periodic_runs)}

# SQL for what SQL expresses; tests/llm/test_brute_force.py and test_operators.py hold the others against plain Python, round trips, held-out accuracy or planted cases.
ORACLES = {
    "op6_chunk_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}
