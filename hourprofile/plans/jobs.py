"""The three jobs of the application, each one Spark plan per stage.

* ``profile_job``  -- observations + stations -> hourly profile table.
* ``train_job``    -- observations -> category mapping + 24 models (one Gram pass).
* ``publish`` / ``score_stream`` live in ``streaming``.

Paths are caller-provided; intermediate tables go below the session's shared
checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import filters as FL
from ..operators import model as M
from ..operators import profile as P
from ..session import materialize, scratch_dir, scratch_path
from ..spec import ObsSpec, StationSpec


def profile_job(obs_raw: DataFrame, station_raw: DataFrame, obs_spec: ObsSpec,
                station_spec: StationSpec, out: str | None = None, eager: bool = True,
                legacy_int_cast: bool = False) -> DataFrame:
    """Build the profile; write it to ``out`` (Parquet) when given and return
    the written table."""
    prof = P.profile(obs_raw, station_raw, obs_spec, station_spec, eager=eager,
                     legacy_int_cast=legacy_int_cast)
    if out is None:
        return prof
    prof.write.mode("overwrite").parquet(out)
    return obs_raw.sparkSession.read.parquet(out)


def encode_training(spark: SparkSession, rows: DataFrame, spec: ObsSpec,
                    keep: Sequence[str] = (), mapping_path: str | None = None):
    """Materialise the rows, fit the mapping (saved and re-read), encode.

    Returns ``(encoded, mapping, k)``: encoded rows carry ``keep``, the
    ``pos_<field>`` columns and the raw volume columns; ``k`` = one-hot width.
    """
    scratch_dir(spark)  # make sure a checkpoint folder is set (tests)
    # the rows feed both the fit and the encoding: materialise them once
    rows = materialize(rows.select(*keep, *spec.categoricals, *spec.volumes), "train-rows")
    mpath = mapping_path or scratch_path(spark, "mapping")
    E.save_mapping(E.fit(rows, spec.categoricals), mpath)
    mapping = E.load_mapping(spark, mpath)
    k = E.width(mapping)
    enc = E.apply(rows, mapping, spec.categoricals, on_unseen="fail")
    enc = enc.select(*keep, *[f"pos_{c}" for c in spec.categoricals], *spec.volumes)
    return enc, mapping, k


def training_gram(encoded: DataFrame, spec: ObsSpec, k: int) -> DataFrame:
    """The Gram matrix that training reads, ``(i, j, g)``: log volumes rounded to 1e-6
    and summed exactly, so that models don't depend on how the rows are dealt out."""
    rows = encoded.select(F.array(*[F.col(f"pos_{c}") for c in spec.categoricals]).alias("positions"),
                          M.quantised_logs(spec.volumes).alias("qlogs"))
    return M.gram(rows, k, exact=True)


def train_job(spark: SparkSession, obs_raw: DataFrame, spec: ObsSpec, out_dir: str,
              solver: str = "gd", iterations: int = 100, step: float = 0.01):
    """Clean rows (all volumes >= 0), fit and save the mapping, one Gram pass,
    24 fits, save the model table. Returns ``(mapping, models)`` as read back."""
    rows = FL.all_nonnegative(obs_raw, spec.volumes)
    enc, mapping, k = encode_training(spark, rows, spec,
                                      mapping_path=f"{out_dir.rstrip('/')}/mapping")
    g = M.gram_matrix(training_gram(enc, spec, k), k + 25)
    models = M.fit(spark, g, k, solver=solver, iterations=iterations, step=step)
    mpath = M.save(models, f"{out_dir.rstrip('/')}/models")
    return mapping, M.load(spark, mpath)
