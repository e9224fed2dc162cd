"""JDBC source: the profile table as the static side of the lookup join.

Connection options (url, user, password, driver) always come from the
caller; nothing is hard-coded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, table: str, options: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Read a table; filters on the result push down as WHERE clauses.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` parallel range queries.
    """
    r = spark.read.format("jdbc").option("dbtable", table)
    for k, v in options.items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()
