"""Categorical encoder: value -> dense 0-based index per field, one-hot offsets.

The mapping is a DataFrame ``(field_pos, field, value, idx, offset)``:
``idx`` numbers the distinct values of a field in value order (deterministic,
equal to an alphabetical string indexer), ``offset`` is the start of the
field's block in the one-hot layout (fields in spec order, no level dropped),
so the one-hot position of a value is ``offset + idx``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

MAPPING_SCHEMA = T.StructType([
    T.StructField("field_pos", T.IntegerType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("idx", T.IntegerType()),
    T.StructField("offset", T.IntegerType()),
])


def levels(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct non-null ``(field_pos, field, value)`` of every field in one pass.

    One scan, one shuffle: the rows are unpivoted with ``stack`` and
    de-duplicated with a map-side partial aggregate, so a hot value never
    crosses the shuffle more than once per partition.
    """
    pairs = ", ".join(f"{i}, '{f}', CAST(`{f}` AS STRING)" for i, f in enumerate(fields))
    return (df.selectExpr(f"stack({len(fields)}, {pairs}) AS (field_pos, field, value)")
            .where(F.col("value").isNotNull())
            .distinct())


def dense_index(df: DataFrame, group: str, order: str, out: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """0-based dense position of ``order`` within ``group`` (distinct rows), one
    way for every size.

    Distributed like ``zipWithIndex``: range-partition by (group, order), number
    rows inside each partition, add the count of the same group's rows in the
    earlier partitions. The ranged rows with their partition number are written
    once, and both the numbering and the counts read that table: two exchanges of
    their own would sample their bounds separately. No task holds a whole group.
    """
    ranged = df.repartitionByRange(num_partitions, group, order) if num_partitions else df.repartitionByRange(group, order)
    ranged = materialize(ranged.withColumn("_pid", F.spark_partition_id()), "ranged")
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid", group).orderBy(order)))
    counts = ranged.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select(
        F.col("_pid").alias("_bpid"), F.col(group).alias("_bgroup"),
        (F.sum("_n").over(Window.partitionBy(group).orderBy("_pid")
                          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_n")).alias("_base"))
    return (local.join(base, (F.col("_pid") == F.col("_bpid")) & F.col(group).eqNullSafe(F.col("_bgroup")), "left")
            .withColumn(out, (F.col("_base") + F.col("_lrn") - 1).cast("int"))
            .drop("_pid", "_lrn", "_base", "_bpid", "_bgroup"))


def with_offsets(mapping: DataFrame) -> DataFrame:
    """Add ``offset`` = number of levels of all earlier fields."""
    counts = mapping.groupBy("field_pos").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("field_pos").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("field_pos", F.coalesce(F.sum("_n").over(w), F.lit(0))
                         .cast("int").alias("offset"))
    return mapping.join(F.broadcast(offs), "field_pos")


def fit(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Fit the mapping of every field in one pass (no per-field jobs); the
    numbering writes the distinct levels once, so the source is read once."""
    m = materialize(dense_index(levels(df, fields), "field_pos", "value"), "levels")
    return with_offsets(m).select(*MAPPING_SCHEMA.fieldNames())


def level_counts(mapping: DataFrame) -> DataFrame:
    """``(field_pos, field, n_levels, offset, total)``; total = one-hot width."""
    per = mapping.groupBy("field_pos", "field", "offset").agg(
        F.count(F.lit(1)).cast("int").alias("n_levels"))
    # one row per field: the window over all of them is bounded by the field count
    total = F.sum("n_levels").over(Window.partitionBy()).cast("int")
    return per.select("field_pos", "field", "n_levels", "offset", total.alias("total"))


def width(mapping: DataFrame) -> int:
    """Number of one-hot positions (one small aggregate over the mapping)."""
    return int(mapping.agg(F.count(F.lit(1))).first()[0])


def apply(df: DataFrame, mapping: DataFrame, fields: Sequence[str], on_unseen: str = "fail",
          prefix: str = "pos_") -> DataFrame:
    """Add ``pos_<field>`` = one-hot position of each field's value.

    ``on_unseen``: ``fail`` raises on a value missing from the mapping (null
    included), ``skip`` drops such rows, ``null`` keeps them with a null
    position. Whether a field's side is broadcast is left to Spark, by its bytes.
    """
    if on_unseen not in ("fail", "skip", "null"):
        raise ValueError(f"unknown unseen policy {on_unseen!r}")
    m = mapping.select("field_pos", "value", (F.col("offset") + F.col("idx")).alias("_pos"))
    out = df
    how = "inner" if on_unseen == "skip" else "left"
    for i, f in enumerate(fields):
        side = m.where(F.col("field_pos") == i).select(
            F.col("value").alias(f"_v{i}"), F.col("_pos").alias(f"{prefix}{f}"))
        out = out.join(side, F.col(f).cast("string") == F.col(f"_v{i}"), how).drop(f"_v{i}")
        if on_unseen == "fail":
            out = out.withColumn(f"{prefix}{f}", F.when(
                F.col(f"{prefix}{f}").isNull(),
                F.raise_error(F.concat(F.lit(f"unseen value for {f}: "),
                                       F.coalesce(F.col(f).cast("string"), F.lit("null"))))
            ).otherwise(F.col(f"{prefix}{f}")).cast("int"))
    return out


# ------------------------------------------------------------------ persistence
def save_mapping(mapping: DataFrame, path: str) -> str:
    mapping.write.mode("overwrite").parquet(path)
    return path


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MAPPING_SCHEMA).parquet(path)


def mapping_to_json(mapping: DataFrame) -> DataFrame:
    """One-line JSON document: a list of per-field objects ``{"\\"value\\"": idx}``
    (keys carry their quotes, as the line-split trainer produced them).

    The document is one value by format, so it is built in one task; its size
    is the number of levels, not the number of observations.
    """
    per_field = mapping.groupBy("field_pos").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(F.concat(F.lit('"'), F.col("value"), F.lit('"')), F.col("idx"))))).alias("m"))
    doc = per_field.agg(F.array_sort(F.collect_list(F.struct("field_pos", "m"))).alias("fs"))
    return doc.select(F.concat(F.lit("["), F.array_join(F.transform("fs", lambda s: s["m"]), ", "),
                               F.lit("]")).alias("value"))


def save_mapping_json(mapping: DataFrame, path: str) -> str:
    mapping_to_json(mapping).coalesce(1).write.mode("overwrite").text(path)
    return path


def load_mapping_json(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Import the JSON list-of-objects form; quotes around keys are stripped
    and the offsets rebuilt from the level counts."""
    names = F.array(*[F.lit(f) for f in fields])
    doc = spark.read.option("wholetext", True).text(path)
    per_field = doc.select(F.posexplode(F.from_json("value", "array<map<string,int>>"))
                           .alias("field_pos", "m"))
    rows = per_field.select("field_pos", F.explode("m").alias("k", "idx")).select(
        F.col("field_pos").cast("int").alias("field_pos"),
        F.element_at(names, F.col("field_pos") + 1).alias("field"),
        F.btrim(F.col("k"), F.lit('"')).alias("value"),
        F.col("idx").cast("int").alias("idx"))
    return with_offsets(rows).select(*MAPPING_SCHEMA.fieldNames())
