"""Scoring: predict the current hour, compare with the profile, fold by key.

Everything is one DataFrame plan that runs unchanged on a batch or on a
micro-batch: decode -> quarantine -> encode -> predict (broadcast 24 models)
-> profile lookup -> level -> fold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..spec import AVG_COLUMNS, RESULT_COLUMNS, ObsSpec
from . import encode, filters, model


#: Rows up to which a profile is broadcast (some 35 MB with all its averages).
BROADCAST_ROWS = 100_000


def _lookup_side(prof: DataFrame) -> DataFrame:
    """The profile's side of a join with live rows, broadcast if it has few rows and merged
    otherwise. Spark would judge by bytes of compressed files and take an array for one
    element, and so broadcast sides, of live rows too, that are many times as large."""
    small = prof.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(prof) if small else prof.hint("merge")


def attach_profile(df: DataFrame, profile: DataFrame, hour, key: str = "sid") -> DataFrame:
    """Inner lookup of each row's station in the profile (no match -> no row;
    one output per matching profile row, i.e. per lane), adding the profile
    attributes and ``historical`` = the profile's average at ``hour``."""
    h = hour if isinstance(hour, Column) else F.lit(int(hour))
    prof = profile.select(
        F.col("id").alias(key), "location", "latitude", "longitude_w", "lanes", "highway",
        C.at_hour(F.array(*[F.col(a) for a in AVG_COLUMNS]), h).alias("historical"))
    return df.join(_lookup_side(prof), key)


def attach_profile_hours(df: DataFrame, profile: DataFrame, key: str = "sid", volumes: str = "volumes") -> DataFrame:
    """``attach_profile`` for all 24 hours: a row per record, lane and hour with
    ``hour``, ``volume`` (of the array column ``volumes``) and ``historical``. The
    hours unfold after the lookup, so each record is joined once."""
    prof = profile.select(
        F.col("id").alias(key), "location", "latitude", "longitude_w", "lanes", "highway",
        F.array(*[F.col(a) for a in AVG_COLUMNS]).alias("_averages"))
    rest = [c for c in df.columns if c not in (key, volumes)]
    return (df.join(_lookup_side(prof), key).select(
        key, *rest, "location", "latitude", "longitude_w", "lanes", "highway",
        F.posexplode(F.arrays_zip(F.col(volumes).alias("volume"), F.col("_averages").alias("historical"))).alias("hour", "_pair"))
        .select("*", F.col("_pair.volume").alias("volume"), F.col("_pair.historical").alias("historical")).drop("_pair"))


def result_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 12 result columns (after ``keep``). ``longitude`` carries the
    profile's west-positive value, as the result table of the reference stores it."""
    return df.select(
        *keep, "sid", "location", "latitude", F.col("longitude_w").alias("longitude"), "direction",
        "lanes", "roadtype", "highway",
        C.scaled_current("volume").alias("current"),
        "historical", "predicted",
        C.level("volume", "historical").alias("level"),
    ).select(*keep, *RESULT_COLUMNS)


def with_point(result: DataFrame, order: str = "lonlat", srid: int = 4326) -> DataFrame:
    """Add ``geom`` (WKT point) and ``srid`` to result rows, for tables that
    keep a geometry. ``order="latlon"`` reproduces the legacy job, which put the
    latitude first and the stored, west-positive longitude second; ``lonlat`` is
    the x=longitude convention with the signed longitude."""
    lon = F.lit(0.0) - F.col("longitude")
    x, y = (lon, F.col("latitude")) if order == "lonlat" else (F.col("latitude"), F.col("longitude"))
    if order not in ("lonlat", "latlon"):
        raise ValueError(f"unknown order {order!r}")
    return result.withColumn("geom", C.point_wkt(x, y)).withColumn("srid", F.lit(srid))


def score(records: DataFrame, spec: ObsSpec, fields: Mapping[str, str], mapping: DataFrame,
          models: DataFrame, profile: DataFrame, hour, on_unseen: str = "skip",
          keep: Sequence[str] = ()) -> DataFrame:
    """Score raw records (string columns of ``spec``) at ``hour``.

    Rows with a negative or missing volume are dropped here (use
    ``filters.all_nonnegative(..., quarantine=True)`` upstream to keep them).
    ``fields`` names the record columns for ``direction`` and ``roadtype``.
    """
    good = filters.all_nonnegative(records, spec.volumes)
    enc = encode.apply(good, mapping, spec.categoricals, on_unseen=on_unseen)
    return score_encoded(enc, spec, fields, models, profile, hour, keep)


def tagged(decoded: DataFrame, spec: ObsSpec, mapping: DataFrame) -> DataFrame:
    """Decoded records with their one-hot positions and a ``reason``: ``corrupt``,
    ``negative``, ``not_finite``, ``missing``, ``unseen`` (a category that the
    mapping does not know) or ``ok``, the first that holds."""
    enc = encode.apply(decoded, mapping, spec.categoricals, on_unseen="null")
    unseen = F.lit(False)
    for c in spec.categoricals:
        unseen = unseen | F.col(f"pos_{c}").isNull()
    volumes = filters.nonnegative_reason(spec.volumes)
    return enc.withColumn("reason", F.when(F.col("corrupt"), F.lit("corrupt")).when(volumes != "ok", volumes)
                          .when(unseen, F.lit("unseen")).otherwise(F.lit("ok")))


def score_encoded(enc: DataFrame, spec: ObsSpec, fields: Mapping[str, str], models: DataFrame,
                  profile: DataFrame, hour, keep: Sequence[str] = ()) -> DataFrame:
    """Score records that have their one-hot positions (``pos_<field>``)."""
    h = hour if isinstance(hour, Column) else F.lit(int(hour))
    d = model.design(enc.withColumn("sid", C.composite_key(spec.key)), spec.categoricals, spec.volumes, keep=[
        "sid", *keep,
        F.col(fields["direction"]).alias("direction"),
        F.col(fields["roadtype"]).alias("roadtype"),
        C.volume(C.at_hour(F.array(*spec.volumes), h)).alias("volume")])
    # sums over arrays: written out term by term the generated method is too large to be compiled
    pred = model.predict(d, models, h).drop("positions", "logs")
    joined = attach_profile(pred, profile, h)
    return result_columns(joined, keep)


def upsert_fold(df: DataFrame, key: str, seq: Sequence[str] | str,
                latest_cols: Sequence[str] = ("current",), policy: str = "first") -> DataFrame:
    """One row per key, as a keyed upsert leaves the table.

    ``policy="first"``: the first row (smallest ``seq``) wins every column but
    ``latest_cols``, which come from the last row (insert, then on conflict
    update only those). ``policy="latest"``: the last row wins everything.
    ``seq`` must order rows totally within a key; replaying rows already
    folded leaves the result unchanged. Works as a streaming aggregation
    (update mode) with state bounded by the number of keys.
    """
    seq_cols = [seq] if isinstance(seq, str) else list(seq)
    order = F.struct(*[F.col(c) for c in seq_cols])
    cols = [c for c in df.columns if c != key]
    if policy == "latest":
        agg = [F.max_by(F.struct(*cols), order).alias("_last")]
        return df.groupBy(key).agg(*agg).select(key, *[F.col(f"_last.{c}").alias(c) for c in cols])
    if policy != "first":
        raise ValueError(f"unknown policy {policy!r}")
    first_cols = [c for c in cols if c not in latest_cols]
    agg = [F.min_by(F.struct(*first_cols), order).alias("_first"),
           F.max_by(F.struct(*latest_cols), order).alias("_last")]
    return df.groupBy(key).agg(*agg).select(
        key, *[F.col(f"_first.{c}").alias(c) if c in first_cols else F.col(f"_last.{c}").alias(c)
               for c in cols])
