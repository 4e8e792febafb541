"""Corpus cleaning in five stages, each over all documents that the one before kept.

Null and empty texts count as one empty text: never toxic, near to nothing or leaking, and one of
them stays. Rows with a null doc_id pass every filtering stage. Rows of one doc_id with other texts
are documents of their own, but for toxicity and leaks, which drop all rows of the id. Texts are
read whole, other columns pass through the filtering stages, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanternlog.llm import chunk_dedup, decontaminate, jaccard_join, packing, toxicity
from lanternlog.llm.common import scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, k=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("pack", pack),
]

#: SQL expresses neither the classifier nor the tokenizer; tests/llm runs the stages on a small table; of the classifier it asks only that no toxic text stays.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as keep:
        for name, stage in STAGES[:-1]:
            with scratch(spark) as keep_stage:
                docs = keep_stage(stage(spark, docs, sf_dir), f"stage-{name}")
        return keep(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
