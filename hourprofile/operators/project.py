"""Projections: composite keys and typed renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def composite_key(df: DataFrame, cols: Sequence[str], out: str = "id", sep: str = "_",
                  nulls: str = "propagate", drop_parts: bool = False) -> DataFrame:
    """Add ``out`` = parts joined by ``sep``; optionally drop the parts."""
    df = df.withColumn(out, C.composite_key(cols, sep=sep, nulls=nulls))
    return df.drop(*[c for c in cols if c != out]) if drop_parts else df


def typed(df: DataFrame, spec: Mapping[str, tuple[str, str]],
          keep_cols: Sequence[str] = (), legacy_int_cast: bool = False) -> DataFrame:
    """Rename and cast in one projection.

    ``spec`` maps output name -> (source column, SQL type). Unparsable values
    become null (``try_cast``), never an error.
    """
    exprs = [F.col(c) for c in keep_cols]
    for out, (src, dtype) in spec.items():
        if dtype == "string":
            exprs.append(F.col(src).cast("string").alias(out))
        else:
            exprs.append(C.to_number(src, dtype, legacy_int_cast).alias(out))
    return df.select(*exprs)
