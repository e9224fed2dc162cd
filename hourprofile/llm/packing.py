"""Harmonic packing of tokenised documents into training sequences.

A document's ids (with an end id) are cut into pieces: whole sequences first,
then at most one piece of every halved capacity (1024, 512, .. ``MIN_CUT``), and
a rest shorter than ``MIN_CUT``. Piece lengths fall into reciprocal-capacity
classes: class k holds lengths up to capacity // k, and each of its sequences
takes exactly k pieces, so a sequence is filled by counting alone. Tasks number
their own pieces of each class independently; one small table of counts per
(class, task) turns these into global slots, so only the last sequence of a
class is not full. Cut classes fill their sequences without padding; rests pad
a few tokens.

Cases: a null or empty text is one piece (the end id alone); repeated rows are
documents of their own; a null doc_id stays null; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import byte_bpe
from .common import slices, table

CAPACITY = 2048
MIN_CUT = 64
END_ID = 1
#: Pieces per sequence of the classes of rests (capacity // k is the longest length).
REST_CLASSES = (32, 40, 48, 64, 85, 128, 256, 512, 1024, 2048)

_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "per_sequence int, part int, rank long")


def cut_lengths(n: int, capacity: int = CAPACITY, least: int = MIN_CUT) -> list[int]:
    """Piece lengths of a document of ``n`` ids."""
    out, size = [capacity] * (n // capacity), capacity // 2
    n %= capacity
    while size >= least:
        if n >= size:
            out.append(size)
            n -= size
        size //= 2
    return out + [n] * (n > 0)


def class_of(length: int, capacity: int = CAPACITY, least: int = MIN_CUT) -> int:
    """Pieces per sequence for a piece of this length."""
    if length >= least:
        return capacity // length
    return max(k for k in REST_CLASSES if capacity // k >= length)


def pieces(docs: DataFrame, path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """Cut every document; with ``keep_ids`` each piece carries its ids (little-endian
    unsigned 32-bit)."""
    classes = np.array([0] + [class_of(n) if n < MIN_CUT else CAPACITY // n for n in range(1, CAPACITY + 1)])
    schema = _PIECES + (", ids binary" if keep_ids else "")

    def run(batches):
        bpe = byte_bpe.load(path, pattern)
        part, seen = TaskContext.get().partitionId(), dict.fromkeys(classes.tolist(), 0)
        for batch in slices(batches, "text", 4 << 20):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(bpe.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                raw, at = memoryview(ids.tobytes()), 0
                for n in cut_lengths(len(ids)):
                    k, own = int(classes[n]), raw[4 * at:4 * (at + n)]
                    rows.append((doc_id, at, n, zlib.crc32(own), len(ids), k, part, seen[k]) + ((bytes(own),) if keep_ids else ()))
                    seen[k] += 1
                    at += n
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()] + [pa.binary()] * keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset`` there."""
    cut = table(pieces(docs, path, pattern, keep_ids), "packing-pieces")
    counts = cut.groupBy("per_sequence", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("per_sequence").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = table(counts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "packing-counts")
    # one row per class
    bins = counts.groupBy("per_sequence").agg(F.ceil(F.sum("n") / F.col("per_sequence")).alias("bins"))
    first = Window.orderBy("per_sequence").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(F.col("per_sequence").alias("c"), F.coalesce(F.sum("bins").over(first), F.lit(0)).alias("first"))
    base = (counts.join(bins, counts.per_sequence == bins.c)
            .select(F.col("per_sequence").alias("c"), F.col("part").alias("p"), "before", "first"))
    at = F.col("before") + F.col("rank")
    put = (cut.join(base, (cut.per_sequence == base.c) & (cut.part == base.p))
           .withColumn("sequence_id", (F.col("first") + F.floor(at / F.col("per_sequence"))).cast("long"))
           .withColumn("slot", at % F.col("per_sequence")))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
    # classes below the first of the rests hold one length each
    alike = F.col("per_sequence") < REST_CLASSES[0]
    exact = put.where(alike).withColumn("offset", F.col("slot") * F.col("length"))
    filled = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rest = put.where(~alike).withColumn("offset", F.coalesce(F.sum("length").over(filled), F.lit(0)))
    return exact.select(out).unionByName(rest.select(out))
