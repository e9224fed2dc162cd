"""File sources: CSV with header, raw text lines, streaming CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import filters


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | Sequence[str] | None = None,
             header: bool = True, sep: str = ",", multiline: bool = False) -> DataFrame:
    """CSV directory scan. Names from the header (or the schema); no type inference.

    Without a schema every column is a string, named from the header line. A
    schema avoids the extra pass over the header and pins the types.
    """
    r = (spark.read.option("header", header).option("sep", sep)
         .option("inferSchema", False).option("multiLine", multiline))
    if schema is not None:
        if not isinstance(schema, T.StructType):
            schema = string_schema(schema)
        r = r.schema(schema)
    return r.csv(path)


def read_lines(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               sep: str = ",", strip_quotes: bool = True, header: bool = True) -> DataFrame:
    """Text scan, header dropped, each line split on ``sep`` into named fields.

    Naive splitting as in a line-oriented reader: quotes are not parsed (they
    are stripped from each field when ``strip_quotes``), so a separator inside
    a quoted field splits it. The header is the first line; every line equal to
    it is dropped (each part file of a directory may repeat it). Without
    ``columns`` the names are taken from the header.
    """
    lines = spark.read.text(path)
    if header:
        first = lines.limit(1).collect()
        if not first:
            return spark.createDataFrame([], string_schema(columns or []))
        head = first[0][0]
        lines = filters.drop_header(lines, head)
        if columns is None:
            columns = [c.strip('"') for c in head.split(sep)]
    if columns is None:
        raise ValueError("columns are required when the input has no header")
    parts = F.split(F.col("value"), _regex_escape(sep), -1)
    fields = []
    for i, name in enumerate(columns):
        f = F.get(parts, i)
        fields.append((C.strip_quotes(f) if strip_quotes else f).alias(name))
    return lines.select(*fields)


def _regex_escape(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)


def stream_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
               max_files: int | None = None, sep: str = ",", multiline: bool = False) -> DataFrame:
    """Streaming CSV file source with an explicit schema (new files per trigger)."""
    r = (spark.readStream.schema(schema).option("header", header).option("sep", sep)
         .option("multiLine", multiline))
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.csv(path)


def stream_json_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming source over a message folder written by ``sinks.stream_json_files``
    (the file-backed twin of a Kafka topic): key, value, topic, partition, offset, timestamp."""
    schema = T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ])
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.json(path)
