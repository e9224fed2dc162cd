"""Exact duplicates of texts, whatever their white space, by progressive refinement.

Texts are equal when they are identical after every ``[\\x20\\x09-\\x0D]`` is deleted.
Rows are grouped three times, each time only those that are still in doubt: by the
length of that text, by length and a hash of its first ``PREFIX`` characters, and by
the SHA-256 of the whole. No text is shuffled: the first pass writes length and
prefix hash, the second reads the texts once more and hashes those whose length and
prefix another row has (a bitmap of fixed size tells which; a text that it lets
pass wrongly is alone in the last grouping). Groups are counted with partial
aggregates; a group with more than a thousandth of all rows reaches its rows by a
broadcast, of which there are at most a thousand, all others by a shuffle.

Cases: a null text counts as empty; empty and blank texts are equal; of equal texts
the one with the most code points stays, then the smallest doc_id (null last), and
of rows that agree in both (repeated rows) exactly one; long texts are hashed whole;
an empty table gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import marked, sieved, table, with_group

PREFIX = 64
WHITE = r"[\x20\x09-\x0D]"


def duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", every_digest: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` of every row. ``digest`` is the
    SHA-256 (binary) of texts that were hashed whole, and of all with ``every_digest``."""
    plain = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), WHITE, "")
    key = [F.octet_length("plain").alias("bytes"), F.xxhash64(F.substring("plain", 1, PREFIX)).alias("head")]

    keys = table(docs.select(plain.alias("plain")).select(*key), "exact-keys")
    lengths = keys.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = sieved(keys, lengths, "bytes").groupBy("bytes", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    texts = docs.select(F.col(id_column).alias("doc_id"), F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("points"),
                        plain.alias("plain"))
    found = marked(texts.select("doc_id", "points", "plain", *key), heads, ["bytes", "head"], "doubt")
    digest = F.unhex(F.sha2("plain", 256))
    rows = table(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "points", "doubt",
                              (digest if every_digest else F.when(F.col("doubt"), digest)).alias("digest")), "exact-rows")

    first = F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = table(rows.where("doubt").groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first"))
                   .where("group_size > 1").select("digest", "group_size", F.col("first.doc_id").alias("keep_id"),
                                                   F.col("first.row").alias("keep_row")), "exact-groups")
    doubted = with_group(rows.where("doubt"), groups, "digest", "group_size", rows.count())
    alone = rows.where("not doubt").select("*", F.lit(None).cast("long").alias("group_size"),
                                           F.lit(None).cast(rows.schema["doc_id"].dataType).alias("keep_id"), F.lit(None).cast("long").alias("keep_row"))
    grouped = F.col("group_size").isNotNull()
    return doubted.unionByName(alone).select(
        "doc_id", F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"), "digest")
