"""Vector code compression: product codes with codebooks from ball k-means.

Each component x of a vector becomes the integer floor(256 x), a vector is cut into
equal consecutive parts, and every part position has a codebook, which starts as that
part of the rows with the smallest ids. A round assigns each part to the nearest entry
(squared Euclidean distance, ties to the lower index) and moves each entry to the
floored mean of its parts; at the end parts are assigned once more.

An entry and the parts assigned to it are a ball. With the entry moved, half the way
from it to another entry bounds what can go wrong: a part nearer than that to its own
entry can't be nearer to the other one. So the ball's radius tells its neighbour entries;
parts in the stable core, nearer than half the way to the first neighbour, keep
their entry without any further distance, and a part in the k-th annular ring is compared
with the first k neighbours only. All comparisons are of squared integers, without a
root, so results are exact, ties included. The first assignment starts with all
parts in the ball of entry 0. A ball here is what a batch holds of it: its radius is
smaller, which leaves fewer neighbours, and needs no pass of its own.

Spark reads, assigns and writes the rows of each round as a table; per-task sums are
added by a shuffle, and only entries (parts x entries x part length numbers, whatever the
row count) pass through the driver.

Cases: rows whose vector is null, empty or holds null or non-finite components are
dropped, as are those of another length than the first row's; that length must be a multiple
of the number of parts; fewer rows than entries make smaller codebooks; ids may be
null (last) or repeated (rows of their own, in the order of their components); a null
label is a label; an empty table gives no rows; other columns are not read. Components
so large that a distance would not fit 64 bits are an error (``ValueError``).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, with_group

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows that numpy handles at once.
BLOCK = 4096


class Compressed(NamedTuple):
    #: vec_id, label, code (binary, one byte a part), error, label_error
    codes: DataFrame
    #: (part, entry, component) integers
    books: np.ndarray


class Rings:
    """Neighbours of every entry of one codebook, nearest first, and how far they are."""

    def __init__(self, book: np.ndarray):
        self.book = book
        gap = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
        np.fill_diagonal(gap, -1)  # an entry itself comes first, before its equals
        order = np.argsort(gap, axis=1, kind="stable")
        self.near = order[:, 1:]
        self.gap = np.take_along_axis(gap, order, 1)[:, 1:]

    def assign(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every part and the squared distance; ``own`` is the entry of each before."""
        m = len(self.book)
        d = ((x - self.book[own]) ** 2).sum(1)
        best = d * m + own
        ring = np.zeros(len(x), np.int64)
        for e in np.flatnonzero(np.bincount(own, minlength=m)):
            ball = np.flatnonzero(own == e)
            reach = 4 * d[ball]
            neighbours = self.gap[e, :np.searchsorted(self.gap[e], reach.max(), side="right")]
            ring[ball] = np.searchsorted(neighbours, reach, side="right")
        out = np.flatnonzero(ring)  # the others are in the stable core
        if len(out):
            n = ring[out]
            start = np.cumsum(n) - n
            part = np.repeat(out, n)
            rival = self.near[own[part], np.arange(len(part)) - np.repeat(start, n)]
            key = ((x[part] - self.book[rival]) ** 2).sum(1) * m + rival
            best[out] = np.minimum(best[out], np.minimum.reduceat(key, start))
        return best % m, best // m


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _assigned(rows: DataFrame, books: np.ndarray, last: bool) -> DataFrame:
    parts, m, width = books.shape
    limit = 1 << 62
    had = "code" in rows.columns

    def run(batches):
        rings = [Rings(b) for b in books]
        for batch in (b.slice(k, BLOCK) for b in batches for k in range(0, b.num_rows, BLOCK)):
            x = _matrix(batch.column("ints"), parts * width)
            most = max(int(np.abs(x).max()), int(np.abs(books).max()))
            if 4 * most * most * parts * width * m >= limit:
                raise ValueError(f"components of up to {most} don't leave 64 bits for distances")
            before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), parts) if had else None
            code, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                own = before[:, p].astype(np.int64) if had else np.zeros(len(x), np.int64)
                code[:, p], d = rings[p].assign(x[:, p * width:(p + 1) * width], own)
                error += d
            raw = code.tobytes()
            codes = pa.array([raw[k:k + parts] for k in range(0, len(raw), parts)], pa.binary())
            found = pa.array(error) if last else batch.column("ints")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), codes, found],
                                             ["vec_id", "label", "code", "error" if last else "ints"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {kind}, code binary, {'error long' if last else 'ints array<bigint>'}")


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floored mean of its parts; unused ones stay."""
    parts, m, width = books.shape

    def run(batches):
        n, s = np.zeros((parts, m), np.int64), np.zeros((parts, m, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("ints"), parts * width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), parts)
            for p in range(parts):
                n[p] += np.bincount(code[:, p], minlength=m)
                np.add.at(s[p], code[:, p], x[:, p * width:(p + 1) * width])
        p, e, c = (a.ravel() for a in np.indices(s.shape))
        used = np.repeat(n.ravel(), width) > 0
        yield pa.RecordBatch.from_arrays([pa.array(a[used]) for a in (p, e, c, np.repeat(n.ravel(), width), s.ravel())], ["p", "e", "c", "n", "s"])

    sums = rows.select("code", "ints").mapInArrow(run, "p long, e long, c long, n long, s long")
    out = books.copy()
    for r in sums.groupBy("p", "e", "c").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        out[r.p, r.e, r.c] = r.s // r.n
    return out


def compress(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codes of all usable rows, their squared errors, errors summed by label, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code byte tells 256 entries apart at most")
    kept = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN sorts above infinity
    kept = kept.where((F.size("v") > 0) & finite)
    ints = F.transform("v", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = kept.select("vec_id", "label", ints.alias("ints"))
    start = [r.ints for r in rows.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()]
    dim = len(start[0]) if start else 0
    start = [v for v in start if len(v) == dim]
    if dim % parts:
        raise ValueError(f"vectors of length {dim} can't be cut into {parts} equal parts")
    books = np.array(start, np.int64).reshape(len(start), parts, dim // parts).transpose(1, 0, 2)
    rows = rows.where(F.size("ints") == dim)
    if start:
        for _ in range(rounds):
            rows = table(_assigned(rows, books, last=False), "ball-round")
            books = _moved(rows, books)
        rows = table(_assigned(rows, books, last=True), "ball-codes")
    else:
        rows = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
    sums = table(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "ball-labels")
    codes = with_group(rows, sums, "label", "n", rows.count()).select("vec_id", "label", "code", "error", "label_error")
    return Compressed(codes, books)
