"""Near-duplicate embeddings by p-stable hashing and exact cosines.

Normalised vectors at cosine ``THRESHOLD`` are a known distance apart. A table of
the index projects a vector on normal directions, quantises each projection with
``WIDTH`` and so has a bucket of k integers, together with the label. k grows with
the logarithm of the rows per label, so that a vector meets about ``STRANGERS``
unrelated ones per table; the number of tables follows from ``MISS``, the share of
pairs right at the threshold that may be missed (closer pairs are found more surely).

Equal vectors of a label are one class and go through the index once. Buckets with
one class are dropped before any vector moves. A bucket larger than ``BLOCK`` is
cut into blocks by a hash, and every two blocks meet as a group of their own, so
no task holds a bucket. A group counts each vector's links (in the first table in
which a pair shares a bucket) and gives spanning edges, never the pairs.

Cases: a null label, a null or empty vector, a zero vector and one with a null,
NaN or infinite component link with nothing; vectors of different lengths don't
link; repeated rows are linked to each other; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, table

THRESHOLD = 0.93
WIDTH = 1.5
STRANGERS = 1.0
MISS = 0.005
BLOCK = 256
SEED = 5


def same_bucket(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees at this distance."""
    r = width / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def sizes(rows_per_label: int) -> tuple[int, int]:
    """(projections per table, tables)."""
    stranger, near = same_bucket(math.sqrt(2)), same_bucket(math.sqrt(2 - 2 * THRESHOLD))
    k = max(2, math.ceil(math.log(max(2.0, rows_per_label / STRANGERS)) / -math.log(stranger)))
    return k, math.ceil(math.log(MISS) / math.log(1 - near ** k))


class Index:
    def __init__(self, dim: int, k: int, tables: int):
        rng = np.random.default_rng([SEED, dim])
        self.k, self.tables = k, tables
        self.directions = rng.standard_normal((dim, tables * k))
        self.shifts = rng.uniform(0, WIDTH, tables * k)
        self.mixers = rng.integers(1, 1 << 62, k) | 1

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per row and table."""
        q = np.floor((unit @ self.directions + self.shifts) / WIDTH).astype(np.int64)
        return (q.reshape(len(unit), self.tables, self.k) * self.mixers).sum(2)


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in column]) if len(column) else np.zeros((0, 1))


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and v: the components as double bytes, null if the vector can't link."""

    def run(batches):
        for b in batches:
            out = []
            for label, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                ok = label is not None and x and None not in x
                x = np.array(x, np.float64) if ok else None
                out.append(x.tobytes() if ok and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "v"])

    return (rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
            .mapInArrow(run, "vec_id long, label string, v binary"))


def _pairs(keys: np.ndarray, block: np.ndarray, cross: np.ndarray, unit: np.ndarray):
    """Index pairs of linked rows within runs of equal keys; where ``cross``, only between two blocks."""
    left, right = [], []
    live, d = np.arange(len(keys)), 0
    while len(live):
        d += 1
        live = live[live + d < len(keys)]
        live = live[keys[live] == keys[live + d]]
        i = live[~cross[live] | (block[live] != block[live + d])]
        close = np.einsum("ij,ij->i", unit[i], unit[i + d]) >= THRESHOLD
        left.append(i[close])
        right.append(i[close] + d)
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))


def _spread(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row reachable by the pairs, for every row."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def partial_links(classes: DataFrame, index: dict[int, Index]) -> DataFrame:
    """(rep, other, n): per group, the links of a class (counted in vectors) and one
    class that it reaches there."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def keys(batches):
        index = shared.value
        for b in batches:
            for x in [b.slice(k, 2000) for k in range(0, b.num_rows, 2000)]:
                dims = np.array([len(v.as_buffer()) // 8 for v in x.column(2)])
                for dim in np.unique(dims):
                    own = x.filter(pa.array(dims == dim))
                    at = index[int(dim)].buckets(unit_rows(matrix(own.column(2))))
                    n, t = at.shape
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0).take(pa.array(np.repeat(np.arange(n), t))), own.column(1).take(pa.array(np.repeat(np.arange(n), t))),
                         pa.array(np.full(n * t, int(dim), np.int32)), pa.array(np.tile(np.arange(t, dtype=np.int32), n)), pa.array(at.ravel())],
                        ["rep", "label", "dim", "t", "bucket"])

    placed = classes.select("rep", "label", "v").mapInArrow(keys, "rep long, label string, dim int, t int, bucket long")
    placed = table(placed.select("rep", "t", F.xxhash64("label", "dim", "t", "bucket").alias("key")), "embed-placed")
    full = table(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "embed-buckets")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    met = placed.join(full, "key").withColumn("block", F.pmod(F.xxhash64("rep", "key"), parts).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
    met = met.select("rep", "t", "block", F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with")).alias("group"),
                     (F.col("block") != F.col("with")).alias("cross"))
    met = met.join(classes.select("rep", "m", "v"), "rep")
    # the group's rows lie together; a batch may end within a group
    met = met.repartition("group").sortWithinPartitions("group")

    def compare(batches):
        rest = None
        for b in _with_end(batches):
            part = rest if b is None else (b if rest is None else pa.Table.from_batches([*rest.to_batches(), b]).combine_chunks())
            if part is None:
                return
            if isinstance(part, pa.RecordBatch):
                part = pa.Table.from_batches([part])
            g = part.column("group").to_numpy()
            cut = len(g) if b is None else int(np.flatnonzero(g == g[-1])[0])
            done, rest = part.slice(0, cut), part.slice(cut)
            if not cut:
                continue
            yield from _linked(done, shared.value)

    return met.select("rep", "m", "t", "block", "group", "cross", "v").mapInArrow(compare, "rep long, other long, n long")


def _with_end(batches):
    yield from (b for b in batches if b.num_rows)
    yield None


def _linked(rows: pa.Table, index: dict[int, Index]):
    dims = np.array([len(v.as_buffer()) // 8 for v in rows.column("v")])
    for dim in np.unique(dims):
        own = rows.filter(pa.array(dims == dim))
        unit = unit_rows(matrix(own.column("v")))
        g, block, cross, t, rep, m = (own.column(c).to_numpy() for c in ("group", "block", "cross", "t", "rep", "m"))
        i, j = _pairs(g, block, cross.astype(bool), unit)
        if not len(i):
            continue
        # a pair counts in the first table in which it shares a bucket
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        found = index[int(dim)].buckets(unit[used])
        a, b = at[:len(i)], at[len(i):]
        first = np.concatenate([(found[a[k:k + 100_000]] == found[b[k:k + 100_000]]).argmax(1) for k in range(0, len(a), 100_000)]) == t[i]
        n = np.bincount(i[first], weights=m[j[first]], minlength=len(g)) + np.bincount(j[first], weights=m[i[first]], minlength=len(g))
        low = _spread(len(g), i, j)
        yield pa.RecordBatch.from_arrays([pa.array(rep[used]), pa.array(rep[low[used]]), pa.array(n[used].astype(np.int64))], ["rep", "other", "n"])


def near_duplicates(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    every = table(vectors(rows).withColumn("row", F.monotonically_increasing_id()), "embed-vectors")
    able = every.where("v is not null")
    key = F.struct("vec_id", "row")
    classes = able.groupBy("label", "v").agg(F.min(key).alias("f"), F.count(F.lit(1)).alias("m"))
    classes = table(classes.select("label", "v", F.col("f.row").alias("rep"), F.col("f.vec_id").alias("least"), "m"), "embed-classes")
    stats = classes.groupBy(F.octet_length("v").alias("b"), "label").agg(F.count(F.lit(1)).alias("n")).groupBy("b").agg(F.max("n").alias("n")).collect()
    index = {r.b // 8: Index(r.b // 8, *sizes(r.n)) for r in stats}
    parts = table(partial_links(classes, index), "embed-links")
    counts = table(parts.groupBy("rep").agg(F.sum("n").alias("n")), "embed-counts")
    comps = components(parts.select(F.col("rep").alias("a"), F.col("other").alias("b")), "embed").withColumnRenamed("id", "rep")
    named = table(classes.select("rep", "label", "v", "least", "m").join(comps, "rep", "left").join(counts, "rep", "left"), "embed-named")
    least = table(named.where("component is not null").groupBy("component").agg(F.min("least").alias("c")), "embed-least")
    named = named.join(least, "component", "left").select(
        "label", "v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("c", "least").alias("c"))
    out = every.join(table(named, "embed-final"), ["label", "v"], "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
