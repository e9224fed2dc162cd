"""Kafka sources (needs the spark-sql-kafka connector on the classpath).

Only option setting lives here; every transformation works on the
transport-free ``(key, value)`` frame, so tests run on file twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns a Kafka source yields that the scoring plan keeps for ordering.
KAFKA_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


def kafka_reader_options(servers: str, topic: str, starting: str = "earliest",
                         **opts) -> dict[str, str]:
    o = {"kafka.bootstrap.servers": servers, "subscribe": topic,
         "startingOffsets": starting}
    o.update({k: str(v) for k, v in opts.items()})
    return o


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 **opts) -> DataFrame:
    """Streaming Kafka source; key and value cast to strings, offsets kept.

    ``minPartitions`` / ``maxOffsetsPerTrigger`` can be passed through ``opts``.
    """
    r = spark.readStream.format("kafka")
    for k, v in kafka_reader_options(servers, topic, starting, **opts).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                               "topic", "partition", "offset", "timestamp")


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               ending: str = "latest", **opts) -> DataFrame:
    """Batch read of a topic range (replay)."""
    r = spark.read.format("kafka")
    o = kafka_reader_options(servers, topic, starting, **opts)
    o["endingOffsets"] = ending
    for k, v in o.items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                               "topic", "partition", "offset", "timestamp")
