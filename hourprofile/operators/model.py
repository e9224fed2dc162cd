"""Per-hour linear models from one distributed pass.

Layout of the full row vector ``z`` (width ``K + 25``):
``[one-hot(K) | log volumes(24) | 1]``. The Gram matrix ``G = sum z z^T``
holds every sum any hour's least-squares problem reads: the model of hour
``h`` uses ``G`` without row/column ``K + h`` as its normal matrix and that
column as right-hand side. So one pass over the data serves all 24 models;
the 24 solves run on a ``(K+25)^2`` matrix, independent of the row count.

Feature order of a model (as the per-hour trainer builds it): one-hot block,
log volumes of the hours before ``h``, then of the hours after ``h``;
intercept separate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C

MODEL_SCHEMA = T.StructType([
    T.StructField("hour", T.IntegerType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("iterations", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("rss", T.DoubleType()),
])
GRAM_SCHEMA = "i INT, j INT, g DOUBLE"


def design(encoded: DataFrame, fields: Sequence[str], volumes: Sequence[str],
           prefix: str = "pos_", keep: Sequence[str] = ()) -> DataFrame:
    """``positions ARRAY<INT>`` (one-hot positions) + ``logs ARRAY<DOUBLE>`` (24)."""
    return encoded.select(
        *keep,
        F.array(*[F.col(f"{prefix}{f}") for f in fields]).alias("positions"),
        F.transform(F.array(*volumes), C.log_volume).alias("logs"))


def label_and_features(logs: Column, hour) -> tuple[Column, Column]:
    """Label = log volume at ``hour``; features = the other 23 in hour order."""
    return C.at_hour(logs, hour), C.without_hour(logs, hour)


# ------------------------------------------------------------------ Gram pass
PACKED = "salt INT, sums BINARY"
_UNIT = 1_000_000            # micro-units of the exact form
_INT64_BUDGET = 1 << 62      # an int64 product holds rows x max|z|^2 up to this
_LIMB = 31                   # exact sums are kept as high * 2^31 + low


def quantised_logs(volumes: Sequence[str]) -> Column:
    """24 log volumes rounded to 1e-6, as integer micro-units (BIGINT)."""
    return F.transform(F.array(*volumes), lambda v: F.round(F.round(C.log_volume(v), 6) * F.lit(1e6)).cast("long"))


def _rows_of(batch, column: str, dtype) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(values), -1)


def _triangles(batch, column: str, k: int, exact: bool) -> Iterator[np.ndarray]:
    """Packed upper triangles of ``z^T z`` of a batch: one row of floats, or two of
    integer limbs for chunks small enough that no int64 product overflows."""
    width, kind, one = k + 25, (np.int64 if exact else np.float64), (_UNIT if exact else 1.0)
    upper = np.triu_indices(width)
    vols, pos = _rows_of(batch, column, kind), _rows_of(batch, "positions", np.int64)
    big = max(_UNIT, int(np.abs(vols).max(initial=0))) if exact else 1
    chunk = max(1, _INT64_BUDGET // (big * big)) if exact else len(vols)
    for s in range(0, len(vols), chunk):
        n = len(vols[s:s + chunk])
        z = np.zeros((n, width), kind)
        z[np.repeat(np.arange(n), pos.shape[1]), pos[s:s + n].ravel()] = one
        z[:, k:k + 24] = vols[s:s + n]
        z[:, k + 24] = one
        g = (z.T @ z)[upper]
        yield np.stack([g >> _LIMB, g & ((1 << _LIMB) - 1)]) if exact else g[None]


def _added(arrays: Iterator[np.ndarray], exact: bool) -> np.ndarray | None:
    """Sum of packed triangles; the low limbs carry into the high ones."""
    total = None
    for a in arrays:
        total = a.copy() if total is None else total + a
        if exact:
            total[0] += total[1] >> _LIMB
            total[1] &= (1 << _LIMB) - 1
    return total


def _packed(total: np.ndarray | None, salt: int):
    import pyarrow as pa

    if total is not None:
        yield pa.RecordBatch.from_pydict({"salt": pa.array([salt], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def gram_partials(design_df: DataFrame, k: int, exact: bool = False) -> DataFrame:
    """One row per task that has rows: its triangle, packed, and a salt."""
    column = "qlogs" if exact else "logs"

    def partials(batches):
        from math import isqrt

        from pyspark import TaskContext
        found = (t for batch in batches if batch.num_rows for t in _triangles(batch, column, k, exact))
        yield from _packed(_added(found, exact), isqrt(TaskContext.get().partitionId()))

    return design_df.select("positions", column).mapInArrow(partials, PACKED)


def gram(design_df: DataFrame, k: int, exact: bool = False) -> DataFrame:
    """Upper triangle of ``G`` as ``(i, j, g)``, zeros left out.

    Each task folds its rows into one dense triangle (numpy over Arrow batches) and
    emits it packed as a single row. The triangles are added in two levels: the square
    root of a task's number salts it, so about sqrt(tasks) partial sums of at most
    2 sqrt(tasks) triangles each reach the one task of the second level. One row per
    task crosses the first shuffle, whatever the width and the row count, and no task
    holds more than a batch of triangles; hot keys cost nothing extra.

    ``exact=True`` reads ``qlogs`` (``quantised_logs``) instead of ``logs``: products
    are exact int64 matrices over chunks sized from the batch's largest magnitude, sums
    are kept in two integer limbs, and entries come out rounded to 1e-6. The
    result then doesn't depend on partitioning or order.
    """
    import pyarrow as pa

    kind = np.int64 if exact else np.float64

    def unpacked(batches):
        for batch in batches:
            for x in batch.column("sums"):
                yield np.frombuffer(x.as_buffer(), kind).reshape(2 if exact else 1, -1)

    def combined(batches):
        yield from _packed(_added(unpacked(batches), exact), 0)

    def entries(batches):
        total = _added(unpacked(batches), exact)
        if total is None:
            return
        i, j = np.triu_indices(k + 25)
        if exact:
            at = np.flatnonzero(total.any(axis=0))
            whole = [(int(h) << _LIMB) + int(lo) for h, lo in total[:, at].T]  # in units of 1e-12
            g = [(abs(v) + _UNIT // 2) // _UNIT * (1 if v > 0 else -1) / _UNIT for v in whole]
        else:
            at = np.flatnonzero(total[0] != 0.0)
            g = total[0, at]
        yield pa.RecordBatch.from_pydict({"i": pa.array(i[at], pa.int32()), "j": pa.array(j[at], pa.int32()), "g": pa.array(g, pa.float64())})

    sums = gram_partials(design_df, k, exact).repartition("salt").mapInArrow(combined, PACKED)
    return sums.repartition(1).mapInArrow(entries, GRAM_SCHEMA)


def gram_exact(design_q: DataFrame, k: int) -> DataFrame:
    """``gram(..., exact=True)``: ``design_q`` has ``positions`` and ``qlogs``."""
    return gram(design_q, k, exact=True)


def gram_blocks(design_dec: DataFrame, k: int) -> DataFrame:
    """Same numbers as the exact ``gram`` from built-ins only, by blocks (no Python
    workers), as a check of it. Slower: the 325-sum aggregate runs on 38-digit decimals.

    ``design_dec`` has ``positions ARRAY<INT>`` and ``q00 .. q23 DECIMAL(12,6)``
    (separate columns: every sum below references a plain attribute).
    Fixed-point sums are order-independent, so any partitioning gives the
    same numbers. Blocks: one-hot x one-hot = pair counts (pairs of a row's
    own positions, bounded by fields^2), one-hot x (volumes, 1) = per-position
    sums, (volumes, 1) x (volumes, 1) = one global aggregate of 325 sums.
    """
    pos = F.col("positions")
    n = F.size(pos)
    pairs = F.flatten(F.transform(pos, lambda p, i: F.transform(
        F.slice(pos, i + 1, n - i), lambda q: F.struct(F.least(p, q).alias("i"),
                                                        F.greatest(p, q).alias("j")))))
    cc = (design_dec.select(F.explode(pairs).alias("pr"))
          .groupBy(F.col("pr.i").alias("i"), F.col("pr.j").alias("j"))
          .agg(F.count(F.lit(1)).cast("decimal(38,12)").alias("s")))

    lq = [F.col(f"q{h:02d}") for h in range(24)]
    cv = (design_dec.select(F.explode(pos).alias("p"), *[x.alias(f"x{h}") for h, x in enumerate(lq)])
          .groupBy("p").agg(*[F.sum(f"x{h}").alias(f"s{h}") for h in range(24)],
                            F.count(F.lit(1)).alias("n")))
    cv_long = cv.select("p", F.explode(F.array(
        *[F.struct(F.lit(k + h).alias("j"), F.col(f"s{h}").cast("decimal(38,12)").alias("s"))
          for h in range(24)],
        F.struct(F.lit(k + 24).alias("j"), F.col("n").cast("decimal(38,12)").alias("s")))).alias("e")
    ).select(F.col("p").alias("i"), "e.j", "e.s")

    aggs, ids = [], []
    for a in range(25):
        for b in range(a, 25):
            xa = lq[a] if a < 24 else None
            xb = lq[b] if b < 24 else None
            if xa is not None and xb is not None:
                e = F.sum(xa * xb)
            elif xa is not None or xb is not None:
                e = F.sum(xa if xa is not None else xb)
            else:
                e = F.count(F.lit(1))
            aggs.append(e.cast("decimal(38,12)").alias(f"s_{a}_{b}"))
            ids.append((k + a, k + b))
    vv = design_dec.agg(*aggs)
    vv_long = vv.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s_{i - k}_{j - k}").alias("s"))
        for i, j in ids])).alias("e")).select("e.i", "e.j", "e.s")

    out = cc.unionByName(cv_long).unionByName(vv_long)
    return out.select(F.col("i").cast("int"), F.col("j").cast("int"),
                      F.round("s", 6).cast("double").alias("g"))


def gram_matrix(gram_df: DataFrame, width: int) -> np.ndarray:
    """Dense symmetric ``(width, width)`` matrix on the driver (size set by the
    model width, not by the data)."""
    g = np.zeros((width, width))
    for r in gram_df.collect():
        if r["g"] is None or not np.isfinite(r["g"]):
            raise ValueError(f"entry ({r['i']}, {r['j']}) of the Gram matrix is not a finite number")
        g[r["i"], r["j"]] = r["g"]
        g[r["j"], r["i"]] = r["g"]
    return g


# ------------------------------------------------------------------ solvers
def hour_system(g: np.ndarray, k: int, hour: int):
    """(A, b, n) of hour ``hour``: features + bias (last) vs the label column."""
    idx = [*range(k), *[k + j for j in range(24) if j != hour], k + 24]
    a = g[np.ix_(idx, idx)]
    b = g[idx, k + hour]
    n = g[k + 24, k + 24]
    return a, b, n


def gradient_descent(a: np.ndarray, b: np.ndarray, n: float, iterations: int = 100,
                     step: float = 0.01, tol: float = 1e-3):
    """Full-batch gradient descent on squared loss, bias last.

    The recipe of mini-batch SGD with fraction 1.0: initial weights 0 and
    bias 1.0; iteration i moves by ``step / sqrt(i)`` times the mean gradient
    ``(A w - b) / n``; stops from the second iteration on once the change is
    below ``tol * max(|w|, 1)``.
    """
    w = np.zeros(len(b))
    w[-1] = 1.0
    prev = None
    it = 0
    for i in range(1, iterations + 1):
        it = i
        grad = (a @ w - b) / n
        w = w - (step / np.sqrt(i)) * grad
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    return w, it


#: A pivot below this part of its own diagonal entry is taken as zero.
RANK_TOLERANCE = 1e-9


def normal_equations(a: np.ndarray, b: np.ndarray, c: float = 0.0, tol: float = RANK_TOLERANCE):
    """``(w, rank, rss)``: a least-squares solution from the normal equations.

    The one-hot design keeps every level and an intercept, so its columns depend
    on each other. Elimination with diagonal pivots, largest first relative to the
    column's own sum of squares, stops where only dependent columns are left: their
    number gives the rank and their weights stay zero. Predictions and the residual
    sum of squares (``c`` is the label's sum of squares) don't depend on which columns these are.
    """
    d = len(b)
    m = np.zeros((d + 1, d + 1))
    m[:d, :d], m[:d, d], m[d, :d], m[d, d] = a, b, b, c
    scale = np.where(np.diag(a) > 0, np.diag(a), np.inf)
    used: list[int] = []
    free = np.ones(d, bool)
    while free.any():
        share = np.where(free, np.diag(m)[:d] / scale, -1.0)
        p = int(share.argmax())
        if not share[p] > tol:
            break
        row = m[p] / m[p, p]
        m -= np.outer(m[:, p], row)
        m[p] = row
        free[p] = False
        used.append(p)
    w = np.zeros(d)
    w[used] = m[used, d]
    return w, len(used), float(m[d, d])


def fit(spark: SparkSession, g: np.ndarray, k: int, solver: str = "gd", iterations: int = 100,
        step: float = 0.01, tol: float = 1e-3, hours: Sequence[int] = range(24)) -> DataFrame:
    """24 models ``(hour, intercept, coef, iterations, rank, rss)`` from the Gram matrix;
    rank and rss come with ``solver="normal"``."""
    rows = []
    for h in hours:
        a, b, n = hour_system(g, k, h)
        rank = rss = None
        if solver == "gd":
            w, it = gradient_descent(a, b, n, iterations, step, tol)
        elif solver == "normal":
            w, rank, rss = normal_equations(a, b, g[k + h, k + h])
            it = 1
        else:
            raise ValueError(f"unknown solver {solver!r}")
        rows.append((int(h), float(w[-1]), [float(x) for x in w[:-1]], int(it), rank, rss))
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def rule_models(spark: SparkSession, k: int) -> DataFrame:
    """Deterministic model table for checks against SQL (dyadic coefficients,
    exact in binary): intercept ``h/8``; one-hot position ``p``:
    ``((p % 5) - 2) / 64``; volume feature ``m``: ``((m % 4) + 1) / 128``."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    coef = F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda p: ((p % 5) - 2).cast("double") / F.lit(64.0)),
        F.transform(F.sequence(F.lit(0), F.lit(22)),
                    lambda m: ((m % 4) + 1).cast("double") / F.lit(128.0)))
    return hours.select("hour", (F.col("hour").cast("double") / F.lit(8.0)).alias("intercept"),
                        coef.alias("coef"), F.lit(0).alias("iterations"),
                        F.lit(None).cast("int").alias("rank"), F.lit(None).cast("double").alias("rss"))


# ------------------------------------------------------------------ persistence
def save(models: DataFrame, path: str) -> str:
    models.write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


# ------------------------------------------------------------------ scoring
def predict(design_df: DataFrame, models: DataFrame, hour, back_transform: bool = True,
            out: str = "predicted", n_positions: int | None = None, integer: bool = False) -> DataFrame:
    """Add the prediction of the hour's model: ``intercept + sum coef[pos] +
    sum coef * log features``; ``exp`` of it when ``back_transform`` (the log
    offset is not subtracted), truncated to BIGINT with ``integer``. The 24-row model
    table is broadcast.

    With ``n_positions`` (the number of categorical fields) the sums are
    written out term by term with ``element_at`` -- fully inside generated
    code; without it, array lambdas (``aggregate``/``zip_with``) evaluate
    them. Both add left to right, so the results are identical.
    """
    h = hour if isinstance(hour, Column) else F.lit(int(hour))
    if models.limit(25).count() > 24:
        raise ValueError("a model table has one row per hour, 24 at most")
    m = F.broadcast(models.select(F.col("hour").alias("_mh"), "intercept", "coef"))
    df = design_df.join(m, h == F.col("_mh"))
    coef = F.col("coef")
    k = F.size(coef) - F.lit(23)
    if n_positions is not None:
        cat = F.lit(0.0)
        for i in range(n_positions):
            cat = cat + F.element_at(coef, F.col("positions")[i] + 1)
        vol = F.lit(0.0)
        for m in range(23):
            vol = vol + F.element_at(coef, k + F.lit(m + 1)) * C.feature_at(F.col("logs"), h, m)
    else:
        cat = F.aggregate(F.col("positions"), F.lit(0.0),
                          lambda acc, p: acc + F.element_at(coef, p + 1))
        _, feats = label_and_features(F.col("logs"), h)
        vol = F.aggregate(F.zip_with(F.slice(coef, k + 1, 23), feats, lambda c, x: c * x),
                          F.lit(0.0), lambda acc, t: acc + t)
    raw = F.col("intercept") + cat + vol
    value = F.exp(raw) if back_transform else raw
    return df.withColumn(out, value.cast("bigint") if integer else value).drop(
        "_mh", "intercept", "coef")


def _hour_predictions(hours: Sequence[int], weights: np.ndarray, n_positions: int):
    """Arrow function ``(positions, logs) -> ARRAY<DOUBLE>``: a row's predictions by every
    model, in the order of ``hours``, each sum added left to right as ``predict`` adds it."""
    k = weights.shape[1] - 24
    others = np.array([[j for j in range(24) if j != h] for h in hours])

    def numbers(column, width, missing):
        import pyarrow.compute as pc

        flat = column.flatten()
        return flat.fill_null(missing).to_numpy(zero_copy_only=False).reshape(-1, width), pc.is_null(flat).to_numpy(zero_copy_only=False).reshape(-1, width)

    def predictions(positions, logs):
        import pyarrow as pa

        (pos, no_pos), (x, no_x) = numbers(positions, n_positions, 0), numbers(logs, 24, 0.0)
        out, empty = np.empty((len(x), len(hours))), np.empty((len(x), len(hours)), bool)
        for i, (w, at) in enumerate(zip(weights, others)):
            cat, vol = np.zeros(len(x)), np.zeros(len(x))
            for f in range(n_positions):
                cat += w[pos[:, f]]
            for m, j in enumerate(at):
                vol += w[k + m] * x[:, j]
            out[:, i] = w[-1] + cat + vol
            empty[:, i] = no_pos.any(axis=1) | no_x[:, at].any(axis=1)
        values = pa.array(out.ravel(), mask=empty.ravel())
        return pa.ListArray.from_arrays(np.arange(0, out.size + 1, len(hours), dtype=np.int32), values)

    return predictions


def predict_hours(design_df: DataFrame, models: DataFrame, n_positions: int, back_transform: bool = True,
                  out: str = "predicted", integer: bool = False) -> DataFrame:
    """One row per record and hour (column ``hour``), each predicted by its hour's
    model as ``predict`` does.

    A record meets all models at once, as numpy columns in its task, and unfolds into
    hours afterwards: an hour's row neither carries the record's features through a join nor
    evaluates their sum term by term. The model table, 24 rows at most, is sent to the tasks.
    """
    rows = models.select("hour", "intercept", "coef").limit(25).collect()
    if len(rows) > 24:
        raise ValueError("a model table has one row per hour, 24 at most")
    rows = sorted((r for r in rows if r["hour"] in range(24)), key=lambda r: r["hour"])
    if not rows:
        return design_df.withColumns({"hour": F.lit(0), out: F.lit(None).cast("bigint" if integer else "double")}).limit(0)
    hours = [r["hour"] for r in rows]
    weights = np.array([[*r["coef"], r["intercept"]] for r in rows], float)
    every = F.arrow_udf(_hour_predictions(hours, weights, n_positions), "array<double>")
    df = design_df.withColumn("_every", every("positions", "logs"))
    pairs = F.arrays_zip(F.array(*map(F.lit, hours)).alias("hour"), F.col("_every").alias("raw"))
    df = df.select(*design_df.columns, F.explode(pairs).alias("_p"))
    value = F.exp("_p.raw") if back_transform else F.col("_p.raw")
    return df.select(*design_df.columns, F.col("_p.hour").alias("hour"), (value.cast("bigint") if integer else value).alias(out))
