"""The stages of ``corpus_pipeline.py``: each takes (spark, docs, sf_dir) and
returns the documents that stay, with their columns, or the packed pieces.

Shared cases: empty tables stay empty; null texts count as empty; columns beside
doc_id, text, lang, source and n_chars pass through; rows with a null doc_id are
documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, minhash_dedup, packing, pii
from .common import load, table
from .queries import vocabulary

#: Word shingles of near-duplicate stages.
SHINGLE_WORDS = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (null or without letters) go. Where no row is labelled there
    is nothing to learn from, and all texts with a letter stay."""
    keep = docs.columns
    trees = langid.fit(docs)
    if trees is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    mine = docs.select(F.struct(*keep).alias("row"), F.col("text"))
    found = langid.identify(mine, trees)
    return found.where(F.col("lang_pred") != "und").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id stays (rows
    that repeat a doc_id stay or go together)."""
    found = minhash_dedup.classes(docs.select("doc_id", "text"), SHINGLE_WORDS)
    gone = found.where(~F.col("kept") & (F.col("n_shingles") > 0)).select("doc_id").where("doc_id is not null").distinct()
    return docs.join(table(gone, "dedup-gone"), "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold an item of ``benchmark`` go."""
    return decontam.without(docs, load(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    out = pii.mask(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences, with their ids."""
    return packing.pack(docs, *vocabulary())
