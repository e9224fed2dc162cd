"""Sinks: files, Kafka, JDBC, console/memory.

Kafka and JDBC sinks are option layers over Spark's own writers; every
transformation before them works on plain DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


# ---------------------------------------------------------------- files
#: Codec of message logs and staged text kept as files; readers know it by the files' names.
LOG_COMPRESSION = "gzip"


def write_csv(df: DataFrame, path: str, header: bool = True, quote_all: bool = False,
              mode: str = "overwrite", compression: str | None = None) -> str:
    (df.write.mode(mode).option("header", header).option("quoteAll", quote_all)
     .option("compression", compression or "none").csv(path))
    return path


def stream_json_files(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      query_name: str | None = None) -> StreamingQuery:
    """File-backed twin of the Kafka sink: append JSON lines ``key, value, ...``, compressed as
    a topic's batches are (every message repeats the names of its fields)."""
    w = (df.writeStream.format("json").option("path", path).option("compression", LOG_COMPRESSION)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def stream_files(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the rows of every micro-batch as Parquet files, each batch whole or not at all."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(**(trigger or {"availableNow": True})).start()


# ---------------------------------------------------------------- kafka
def kafka_writer_options(servers: str, topic: str, **opts) -> dict[str, str]:
    o = {"kafka.bootstrap.servers": servers, "topic": topic}
    o.update({k: str(v) for k, v in opts.items()})
    return o


def write_kafka(df: DataFrame, servers: str, topic: str, **opts) -> None:
    """Batch publish of a (key, value) frame; partition-parallel producers."""
    w = df.select("key", "value").write.format("kafka")
    for k, v in kafka_writer_options(servers, topic, **opts).items():
        w = w.option(k, v)
    w.save()


def stream_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
                 trigger: dict | None = None, **opts) -> StreamingQuery:
    w = df.select("key", "value").writeStream.format("kafka").option("checkpointLocation", checkpoint)
    for k, v in kafka_writer_options(servers, topic, **opts).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# ---------------------------------------------------------------- console / memory
def stream_console(df: DataFrame, mode: str = "update", truncate: bool = False) -> StreamingQuery:
    return (df.writeStream.outputMode(mode).format("console")
            .option("truncate", truncate).start())


def stream_memory(df: DataFrame, name: str, mode: str = "append",
                  trigger: dict | None = None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).format("memory").queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# ---------------------------------------------------------------- jdbc
_SQL_TYPES = {
    T.StringType: "TEXT",
    T.DoubleType: "DOUBLE PRECISION",
    T.FloatType: "REAL",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.ShortType: "SMALLINT",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.DateType: "DATE",
}


def _sql_type(dt: T.DataType) -> str:
    for k, v in _SQL_TYPES.items():
        if isinstance(dt, k):
            return v
    raise TypeError(f"no SQL type for {dt}")


def create_table_sql(table: str, schema: T.StructType, key: Sequence[str] = ()) -> str:
    """DDL for a table with the schema's columns and an optional primary key."""
    cols = [f'"{f.name}" {_sql_type(f.dataType)}' + (" NOT NULL" if f.name in key else "")
            for f in schema.fields]
    if key:
        cols.append("PRIMARY KEY (" + ", ".join(f'"{k}"' for k in key) + ")")
    return f"CREATE TABLE {table} (" + ", ".join(cols) + ")"


def merge_sql(table: str, staging: str, key: Sequence[str], columns: Sequence[str],
              update_cols: Sequence[str]) -> str:
    """One set-based upsert: insert new keys, on an existing key update only
    ``update_cols`` (standard MERGE)."""
    on = " AND ".join(f't."{k}" = s."{k}"' for k in key)
    upd = ", ".join(f'"{c}" = s."{c}"' for c in update_cols)
    ins_cols = ", ".join(f'"{c}"' for c in columns)
    ins_vals = ", ".join(f's."{c}"' for c in columns)
    sql = f"MERGE INTO {table} t USING {staging} s ON {on}"
    if update_cols:
        sql += f" WHEN MATCHED THEN UPDATE SET {upd}"
    return sql + f" WHEN NOT MATCHED THEN INSERT ({ins_cols}) VALUES ({ins_vals})"


def on_conflict_sql(table: str, staging: str, key: Sequence[str], columns: Sequence[str],
                    update_cols: Sequence[str]) -> str:
    """The same upsert for databases without MERGE (INSERT .. ON CONFLICT)."""
    cols = ", ".join(f'"{c}"' for c in columns)
    keys = ", ".join(f'"{k}"' for k in key)
    upd = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in update_cols)
    act = f"DO UPDATE SET {upd}" if update_cols else "DO NOTHING"
    return f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} ON CONFLICT ({keys}) {act}"


def write_jdbc(df: DataFrame, table: str, options: dict, mode: str = "overwrite",
               create_table_options: str | None = None) -> None:
    """Partition-parallel JDBC write (each task opens its own connection)."""
    w = df.write.format("jdbc").mode(mode).option("dbtable", table)
    for k, v in options.items():
        w = w.option(k, v)
    if create_table_options:
        w = w.option("createTableOptions", create_table_options)
    w.save()


@contextmanager
def _connection(spark, options: dict):
    """A connection of the JVM's JDBC driver."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in options:
            props.setProperty(k, options[k])
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(options["url"], props)
    try:
        yield conn
    finally:
        conn.close()


def execute_jdbc(spark, options: dict, statements: Sequence[str]) -> None:
    """Run DDL/DML statements in one transaction through the JVM JDBC driver
    (statements only -- no rows pass through the driver)."""
    with _connection(spark, options) as conn:
        try:
            conn.setAutoCommit(False)
            st = conn.createStatement()
            for s in statements:
                st.execute(s)
            conn.commit()
        except Exception:
            conn.rollback()
            raise


def ensure_table(spark, table: str, schema: T.StructType, key: Sequence[str], options: dict) -> None:
    """Create the keyed result table once if it does not exist. The database is asked for the
    name itself, so that any other error (no connection, no rights) is raised, not read as
    an absent table."""
    if not _table_exists(spark, table, options):
        execute_jdbc(spark, options, [create_table_sql(table, schema, key)])


def _table_exists(spark, table: str, options: dict) -> bool:
    """Whether the connection's metadata names the table, in any case of letters."""
    schema, _, name = table.rpartition(".")
    with _connection(spark, options) as conn:
        found = conn.getMetaData().getTables(None, None, "%", None)
        while found.next():
            if found.getString("TABLE_NAME").lower() == name.strip('"').lower() and \
                    (not schema or (found.getString("TABLE_SCHEM") or "").lower() == schema.strip('"').lower()):
                return True
    return False


def upsert_jdbc(df: DataFrame, table: str, key: Sequence[str], update_cols: Sequence[str],
                options: dict, staging: str | None = None) -> None:
    """Keyed upsert of a batch that holds at most one row per key (fold first).

    Rows go partition-parallel into a staging table, then one MERGE applies
    them in a single transaction.
    """
    staging = staging or f"{table}_staging"
    write_jdbc(df, staging, options, mode="overwrite")
    execute_jdbc(df.sparkSession, options,
                 [merge_sql(table, staging, key, df.columns, update_cols)])


def with_metrics(df: DataFrame, name: str = "batch", *more: Column) -> DataFrame:
    """Count the rows (and whatever ``more`` aggregates) in the plan: a stream's listener or
    progress gives them per micro-batch, a batch query's ``Observation`` once."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *more)
