"""From raw documents to packed training sequences.

Five stages, each over all that its predecessor kept: texts without a language
go; of each group of near-duplicates the smallest id stays; texts that hold a
benchmark item go; personal data is masked; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourprofile.llm import stages
from hourprofile.session import scratch_path

STAGES = [
    ("language_id", stages.language),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("pii", stages.mask_pii),
    ("pack", stages.pack),
]

#: Trained models and vocabularies can't be said in SQL; tests/llm compares each
#: stage and the whole with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
