"""Row filters, with an optional quarantine output instead of silent drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def nonzero_condition(cols: Sequence[str], legacy_int_cast: bool = False) -> Column:
    """Every listed column parses to a number different from zero.

    Null or text never passes. ``legacy_int_cast`` compares after truncating to
    an integer, so ``0.5`` counts as zero (the behaviour of comparing a string
    column with the integer literal 0 under non-ANSI casts).
    """
    cond = F.lit(True)
    for c in cols:
        v = C.to_number(c, "int", True) if legacy_int_cast else C.to_number(c, "double")
        cond = cond & F.coalesce(v != 0, F.lit(False))
    return cond


def nonzero(df: DataFrame, cols: Sequence[str], legacy_int_cast: bool = False) -> DataFrame:
    return df.filter(nonzero_condition(cols, legacy_int_cast))


#: Columns in a conjunct of ``all_nonnegative_condition``.
_CONJUNCT = 3


def _all_finite_nonnegative(cols: Sequence[str]) -> Column:
    # the root of a negative number is NaN, which sorts above infinity
    return F.forall(F.array(*cols), lambda x: F.sqrt(C.to_number(x, "double")) < F.lit(float("inf")))


def all_nonnegative_condition(cols: Sequence[str]) -> Column:
    """True when every value parses, is finite and >= 0; false when one is negative
    or not finite; null when one is missing or unparsable (and none is false).

    Written as a conjunction over few columns each (same three-valued result as one
    ``forall``): a conjunct is its own constraint, so the optimizer's constraint
    propagation stays linear in the number of columns instead of doubling per aliased
    column. Over arrays, since a cast per column written out makes a generated method
    beyond the 8000 bytes up to which the JVM compiles it.
    """
    cond = None
    for i in range(0, len(cols), _CONJUNCT):
        p = _all_finite_nonnegative(cols[i:i + _CONJUNCT])
        cond = p if cond is None else cond & p
    return cond if cond is not None else F.lit(True)


def nonnegative_reason(cols: Sequence[str]) -> Column:
    """``ok`` / ``negative`` / ``not_finite`` / ``missing`` for one row, in a single pass."""
    ok = _all_finite_nonnegative(cols) if cols else F.lit(True)
    negative = F.exists(F.array(*cols), lambda x: F.coalesce(C.to_number(x, "double") < 0, F.lit(False))) if cols else F.lit(False)
    return (F.when(ok, F.lit("ok")).when(negative, F.lit("negative"))
            .when(ok.isNull(), F.lit("missing")).otherwise(F.lit("not_finite")))


def all_nonnegative(df: DataFrame, cols: Sequence[str], quarantine: bool = False):
    """Keep rows whose listed values are all >= 0.

    With ``quarantine=True`` returns ``(good, bad)``; ``bad`` carries a
    ``reason`` column (``negative``, ``not_finite`` or ``missing``).
    """
    ok = all_nonnegative_condition(cols)
    if not quarantine:
        return df.filter(ok)
    tagged = df.withColumn("reason", nonnegative_reason(cols))
    good = tagged.filter(F.col("reason") == "ok").drop("reason")
    bad = tagged.filter(F.col("reason") != "ok")
    return good, bad


def drop_header(df: DataFrame, header: str, col: str = "value") -> DataFrame:
    """Drop every line equal to the header (each part file may repeat it)."""
    return df.filter(F.col(col) != F.lit(header))
