"""Hourly profile: join observations to stations, average each hour per group.

Three plans with the same result:

* ``eager=False`` -- join first, then group by the seven profile keys (the
  straightforward plan).
* ``eager=True`` -- average per station id first (partial aggregation on the
  map side, one partial row per id and partition crosses the shuffle), then
  join the result to the distinct station keys. Duplicated station rows
  multiply every observation of a group by the same factor, which leaves an
  average unchanged, so both plans agree. This is the plan for large inputs:
  a hot station id is collapsed by the partial aggregate before any shuffle,
  instead of meeting a join that fans it out per lane.
* ``salted=True`` -- join first, but with the rows of hot ids dealt over salts
  (``skew``); a group's salts are summed and counted apart and then combined. For joined
  rows that something else reads as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..spec import AVG_COLUMNS, HOURS, PROFILE_COLUMNS, PROFILE_KEYS, ObsSpec, StationSpec
from . import filters, project, skew

VOLUME_COLUMNS = tuple(f"volume{h:02d}" for h in HOURS)


def stations(station_raw: DataFrame, spec: StationSpec, legacy_int_cast: bool = False,
             drop_zero_coordinates: bool = True) -> DataFrame:
    """Typed station rows keyed by ``id``: id + the six profile attributes. Lanes are read
    like volumes: decimals truncate. ``legacy_int_cast`` is about the zero test alone."""
    st = station_raw
    if drop_zero_coordinates:
        st = filters.nonzero(st, [spec.latitude, spec.longitude], legacy_int_cast)
    st = st.withColumn("id", C.composite_key(spec.key))
    return project.typed(st, spec.attributes, keep_cols=["id"], legacy_int_cast=True)


def observations(obs_raw: DataFrame, spec: ObsSpec, dtype: str = "bigint",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``id`` + 24 typed volumes ``volume00..volume23`` (+ ``keep`` columns)."""
    # cast over an array: 24 casts written out make a method that the JVM doesn't compile
    typed = obs_raw.select(C.composite_key(spec.key).alias("id"), *keep,
                           F.transform(F.array(*spec.volumes), lambda v: C.volume(v, dtype)).alias("_volumes"))
    return typed.select("id", *keep, *[F.get("_volumes", F.lit(h)).alias(o) for h, o in enumerate(VOLUME_COLUMNS)])


def attach_station(station: DataFrame, obs: DataFrame, salted: bool = False) -> DataFrame:
    """Inner equi-join on ``id``; many-to-many (a station row per lane)."""
    return skew.salted_join(station, obs, "id") if salted else station.join(obs, "id")


def _finish(df: DataFrame) -> DataFrame:
    return df.select(*PROFILE_KEYS, *AVG_COLUMNS,
                     (F.lit(0.0) - F.col("longitude_w")).alias("longitude")).select(*PROFILE_COLUMNS)


def _salted_average(station: DataFrame, obs: DataFrame) -> DataFrame:
    joined = skew.salted_join(station, obs, "id", keep_salt=True)
    parts = joined.groupBy(*PROFILE_KEYS, skew.SALT).agg(
        *[F.sum(F.col(v).cast("double")).alias(f"s_{v}") for v in VOLUME_COLUMNS], *[F.count(v).alias(f"n_{v}") for v in VOLUME_COLUMNS])
    return parts.groupBy(*PROFILE_KEYS).agg(
        *[F.try_divide(F.sum(f"s_{v}"), F.sum(f"n_{v}")).alias(a) for v, a in zip(VOLUME_COLUMNS, AVG_COLUMNS)])


def hourly_average(station: DataFrame, obs: DataFrame, eager: bool = False, salted: bool = False) -> DataFrame:
    """Average of each hour per (id, location, latitude, longitude_w, lanes, type, highway)."""
    if salted:
        return _finish(_salted_average(station, obs))
    avgs = [F.avg(v).alias(a) for v, a in zip(VOLUME_COLUMNS, AVG_COLUMNS)]
    if not eager:
        return _finish(attach_station(station, obs).groupBy(*PROFILE_KEYS).agg(*avgs))
    per_id = obs.groupBy("id").agg(*avgs)
    # dealt by id first, into a fixed number of parts: the rows, which may unfold from few small
    # files, cross one shuffle and no task holds more than its part of the distinct keys
    parts = int(station.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = station.select(*PROFILE_KEYS).repartition(parts, "id").distinct()
    return _finish(keys.join(per_id, "id"))


def profile(obs_raw: DataFrame, station_raw: DataFrame, obs_spec: ObsSpec,
            station_spec: StationSpec, eager: bool = True,
            legacy_int_cast: bool = False, salted: bool = False) -> DataFrame:
    """Full profile job from raw (string) observation and station frames."""
    st = stations(station_raw, station_spec, legacy_int_cast)
    ob = observations(obs_raw, obs_spec)
    return hourly_average(st, ob, eager=eager, salted=salted)
