"""Message encoding for the log (Kafka or its file twin) and decoding back.

Two value shapes: ``object`` -- a JSON object of the record (null fields
omitted) -- and ``array`` -- a JSON array of the raw fields in record order.
Both decode to the same typed frame, also mixed in one log (``decode_mixed``). Works on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C

CORRUPT = "_corrupt_record"


def encode(df: DataFrame, key=None, shape: str = "object",
           columns: Sequence[str] | None = None, offset: Column | None = None) -> DataFrame:
    """``(key, value)`` frame, with ``offset`` too if its place in the log is given.

    ``key``: ``None`` -> ingest time as text (every row of a micro-batch gets
    the same key); a list of column names -> their composite key; a Column.
    """
    cols = list(columns or df.columns)
    if shape == "object":
        value = F.to_json(F.struct(*[F.col(c) for c in cols]))
    elif shape == "array":
        value = F.to_json(F.array(*[F.col(c).cast("string") for c in cols]))
    else:
        raise ValueError(f"unknown shape {shape!r}")
    if key is None:
        k = F.current_timestamp().cast("string")
    elif isinstance(key, Column):
        k = key
    else:
        k = C.composite_key(list(key))
    place = [] if offset is None else [offset.cast("long").alias("offset")]
    return df.select(k.alias("key"), value.alias("value"), *place)


def _value(df: DataFrame, value_col: str, unescape: bool) -> Column:
    v = F.col(value_col).cast("string")  # Kafka delivers bytes
    if unescape:
        v = F.regexp_replace(v, r'\\"', '"')
    return v


def decode(df: DataFrame, schema: T.StructType, shape: str = "object", mode: str = "PERMISSIVE",
           unescape: bool = False, unquote: bool = False, value_col: str = "value", keep: Sequence[str] = ("key",),
           corrupt_col: str | None = "corrupt") -> DataFrame:
    """Parse ``value`` into the schema's columns (``data.*``) next to ``keep``.

    ``mode="PERMISSIVE"``: a malformed message gives a row of nulls and
    ``corrupt = true``; ``mode="FAILFAST"``: the query fails on it.
    ``shape="array"`` reads a JSON array of strings by position; with ``unquote``
    the quotes that raw fields carry are stripped. A null value and an array of
    the wrong length are malformed too; ``{}`` is a record of nulls.
    """
    v = _value(df, value_col, unescape)
    names = schema.fieldNames()
    if shape == "object":
        sch = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        opts = {"mode": mode}
        if mode == "PERMISSIVE":
            opts["columnNameOfCorruptRecord"] = CORRUPT
        parsed = df.select(*keep, F.from_json(v, sch if mode == "PERMISSIVE" else schema, opts)
                           .alias("data"), v.alias("_raw"))
        bad = (F.col("_raw").isNull() | F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull()) \
            if mode == "PERMISSIVE" else F.lit(False)
        out = [F.when(~bad, F.col(f"data.{n}")).alias(n) for n in names]
    elif shape == "array":
        opts = {"mode": mode}
        parsed = df.select(*keep, F.from_json(v, "array<string>", opts).alias("data"), v.alias("_raw"))
        bad = F.coalesce(F.size("data") != len(names), F.lit(True)) if mode == "PERMISSIVE" else F.lit(False)
        field = (lambda i: C.strip_quotes(F.get(F.col("data"), i))) if unquote else (lambda i: F.get(F.col("data"), i))
        out = [F.when(~bad, field(i).try_cast(schema[n].dataType)).alias(n) for i, n in enumerate(names)]
    else:
        raise ValueError(f"unknown shape {shape!r}")
    extra = [bad.alias(corrupt_col)] if corrupt_col else []
    return parsed.select(*keep, *out, *extra)


def decode_mixed(df: DataFrame, schema: T.StructType, unquote: bool = True, value_col: str = "value",
                 keep: Sequence[str] = ("key",), corrupt_col: str = "corrupt") -> DataFrame:
    """``decode`` for a log that holds both shapes: each message is parsed once as a
    VARIANT and read by what it is, an object by its names, an array by position.

    Everything else is malformed and gives nulls and ``corrupt = true``: cut or invalid
    JSON (an object that repeats a name too), a null value, JSON null, a number, a
    text, and an array of the wrong length. A field that its type can't hold is null.
    """
    parsed = df.select(*keep, F.try_parse_json(F.col(value_col).cast("string")).alias("_v"))
    items = F.try_variant_get("_v", "$", "array<string>")
    parsed = parsed.select(*keep, "_v", F.schema_of_variant("_v").startswith("OBJECT").alias("_object"), items.alias("_items"))
    names = schema.fieldNames()
    bad = ~F.coalesce(F.col("_object") | (F.size("_items") == len(names)), F.lit(False))
    out = []
    for i, n in enumerate(names):
        item = F.get("_items", F.lit(i))
        field = F.when(F.col("_object"), F.try_variant_get("_v", f"$['{n}']", "string")).otherwise(C.strip_quotes(item) if unquote else item)
        out.append(F.when(~bad, field.try_cast(schema[n].dataType)).alias(n))
    return parsed.select(*keep, *out, bad.alias(corrupt_col))


def parsed_once(decoded: DataFrame) -> DataFrame:
    """The same rows behind a generator. Filters of later steps are pushed through plain
    projections, each with a copy of the parser for every field it looks at, but not through this."""
    return decoded.select(F.explode(F.array(F.struct(*decoded.columns))).alias("_record")).select("_record.*")


def quarantine(decoded: DataFrame, corrupt_col: str = "corrupt"):
    """Split a decoded frame into ``(good, bad)`` on the corrupt flag."""
    return (decoded.filter(~F.col(corrupt_col)).drop(corrupt_col),
            decoded.filter(F.col(corrupt_col)))
