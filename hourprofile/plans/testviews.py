"""Observation and station views built from the driver tables.

The reference reads CSV files that are not part of its checkout; these views
play their role with the same shape (all-string columns, 24 hour columns).

* ``observations`` -- ``events`` summed per (user, event type, day) into 24
  hourly columns of integer cents (an hour without events counts 0, like a
  counter that saw no traffic), joined to ``customer`` for the station
  attributes the record carries (state = nation, segment).
* ``stations`` -- one row per customer x event type x lane, lanes
  ``1 .. 1 + c_nationkey % 2`` (so the join to observations fans out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import HOURS, TEST_RECORD, TEST_VOLUMES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    cents = F.round(F.col("value") * 100).cast("bigint")
    hour = F.hour("ts")
    wide = ev.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(
        *[F.sum(F.when(hour == h, cents).otherwise(F.lit(0).cast("bigint"))).alias(v)
          for h, v in zip(HOURS, TEST_VOLUMES)])
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = wide.join(cust, wide.user_id == cust.c_custkey)
    return j.select(
        F.col("day").cast("string").alias("date"),
        F.lpad(F.dayofmonth("day").cast("string"), 2, "0").alias("day_of_data"),
        F.dayofweek("day").cast("string").alias("day_of_week"),
        F.col("event_type").alias("direction"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state"),
        F.col("c_mktsegment").alias("segment"),
        F.lpad(F.month("day").cast("string"), 2, "0").alias("month_of_data"),
        F.col("user_id").cast("string").alias("station_id"),
        *[F.col(v).cast("string").alias(v) for v in TEST_VOLUMES],
    ).select(*TEST_RECORD)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # one row: the few event types that play the directions of travel
    types = table(spark, sf_dir, "events").where("event_type is not null").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    # a customer unfolds into several rows: dealt out first, a small file is one task's
    c = c.repartition(stage_parts(spark), "c_custkey").crossJoin(F.broadcast(types))
    return c.select(
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state"),
        F.col("c_custkey").cast("string").alias("station_id"),
        F.explode("types").alias("direction"),
        F.col("c_name").alias("location"),
        F.col("c_acctbal").cast("string").alias("latitude"),
        (F.col("c_nationkey") * F.lit(0.5)).cast("string").alias("longitude"),
        F.col("c_nationkey"),
        F.col("c_mktsegment").alias("type"),
        F.when(F.col("c_acctbal") >= 5000, F.lit("Y")).otherwise(F.lit("N")).alias("highway"),
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(1) + F.col("c_nationkey") % 2)).alias("lane")
             ).withColumn("lane_of_travel", F.col("lane").cast("string")).drop("c_nationkey", "lane")


_STAGED: dict[tuple, str] = {}


def staged_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation view materialised once (Parquet table in the shared
    folder) for plans that read it several times."""
    from ..session import materialize
    k = (spark.sparkContext.applicationId, sf_dir, "obs")
    if k not in _STAGED:
        _STAGED[k] = materialize(observations(spark, sf_dir), "obs")
    return _STAGED[k]


def stage_parts(spark: SparkSession) -> int:
    """Number of staged files: the session's shuffle partitions, at least 8."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def files_per_trigger(spark: SparkSession, batches: int = 4) -> int:
    """``maxFilesPerTrigger`` giving about ``batches`` micro-batches over the staged files."""
    return -(-stage_parts(spark) // batches)


def staged_obs_csv(spark: SparkSession, sf_dir: str) -> str:
    """Observations written once per session as quoted CSV with a header
    (every part file repeats the header), below the shared scratch folder."""
    from .. import sinks
    from ..session import scratch_path
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _STAGED:
        # several files (a stream reads them a few per trigger), hashed on
        # (date, station) so a hot day or station spreads over many tasks; the
        # count follows the session's shuffle partitions, at least 8
        obs = staged_observations(spark, sf_dir).repartition(stage_parts(spark), "date", "station_id")
        _STAGED[k] = sinks.write_csv(obs, scratch_path(spark, "obs-csv"),
                                     header=True, quote_all=True, compression=sinks.LOG_COMPRESSION)
    return _STAGED[k]
