"""Scalar column expressions (built-in Spark functions only, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first draw of numpy's normal generator after seed(0); the
# simulated "current" volume is volume + volume * 0.5 * this draw.
SEED0_FIRST_NORMAL = 1.764052345967664
# Offset inside the log transform of volumes.
LOG_OFFSET = 0.01
# Level thresholds relative to the historical average.
HIGH_FACTOR = 2.0
LOW_FACTOR = 0.5


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def composite_key(cols: Sequence, sep: str = "_", nulls: str = "propagate") -> Column:
    """Join key parts with ``sep``.

    ``nulls="propagate"``: null if any part is null (``concat`` semantics, not
    ``concat_ws`` which skips nulls). ``nulls="placeholder"``: a null part
    becomes ``*``.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        c = _col(c).cast("string")
        if nulls == "placeholder":
            c = F.coalesce(c, F.lit("*"))
        elif nulls != "propagate":
            raise ValueError(f"unknown null policy {nulls!r}")
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(c)
    return F.concat(*parts)


def strip_quotes(c) -> Column:
    """Remove surrounding double quotes (quotes inside are kept)."""
    return F.btrim(_col(c), F.lit('"'))


def to_number(c, dtype: str, legacy_int_cast: bool = False) -> Column:
    """Tolerant cast: unparsable text gives null instead of failing (ANSI-safe).

    With ``legacy_int_cast`` integral targets accept decimals and truncate
    toward zero, as a non-ANSI string-to-int cast did; text, NaN, infinities and
    what the target can't hold give null.
    """
    c = _col(c)
    if legacy_int_cast and dtype in ("int", "integer", "bigint", "long", "smallint"):
        return F.coalesce(c.try_cast(dtype), c.try_cast("double").try_cast(dtype))
    return c.try_cast(dtype)


def volume(c, dtype: str = "bigint") -> Column:
    """The one cast of volumes, in profile, features and results alike: decimals
    truncate toward zero, bad text and non-finite values give null."""
    return to_number(c, dtype, True)


def log_volume(c) -> Column:
    """``ln(v + 0.01)``; negative input gives null."""
    return F.ln(_col(c).cast("double") + F.lit(LOG_OFFSET))


def volumes_array(cols: Sequence) -> Column:
    return F.array(*[_col(c) for c in cols])


def at_hour(array_col, hour_col) -> Column:
    """Element of a 24-element array at a 0-based hour (column or int)."""
    h = hour_col if isinstance(hour_col, Column) else F.lit(int(hour_col))
    return F.element_at(_col(array_col), h + F.lit(1))


def without_hour(array_col, hour_col) -> Column:
    """The array minus the element at the 0-based hour (hours before, then after)."""
    h = hour_col if isinstance(hour_col, Column) else F.lit(int(hour_col))
    return F.filter(_col(array_col), lambda x, i: i != h)


def feature_at(array_col, hour_col, m: int) -> Column:
    """Element ``m`` of ``without_hour(array, hour)`` without a lambda (stays in
    generated code): index ``m`` below the hour, ``m + 1`` from it on."""
    h = hour_col if isinstance(hour_col, Column) else F.lit(int(hour_col))
    return F.element_at(_col(array_col),
                        F.lit(m + 1) + F.when(F.lit(m) >= h, F.lit(1)).otherwise(F.lit(0)))


def level(volume, historical) -> Column:
    """High above twice the history, Low below half of it, Medium otherwise.

    Null history gives null; zero history makes any positive volume High.
    """
    v, hist = _col(volume), _col(historical)
    return (F.when(hist.isNull() | v.isNull(), F.lit(None).cast("string"))
            .when(v > hist * F.lit(HIGH_FACTOR), F.lit("High"))
            .when(v < hist * F.lit(LOW_FACTOR), F.lit("Low"))
            .otherwise(F.lit("Medium")))


def scaled_current(volume) -> Column:
    """Deterministic stand-in for the simulated live volume.

    ``int(max(v + v * 0.5 * z0, 0))`` with z0 the first seeded normal draw.
    """
    v = _col(volume).cast("double")
    current = F.greatest(v + v * F.lit(0.5) * F.lit(SEED0_FIRST_NORMAL), F.lit(0.0)).try_cast("int")
    return F.when(v.isNotNull(), current)  # greatest() alone would make 0 of null


def point_wkt(lon, lat) -> Column:
    """Well-known-text point, longitude first (SRID 4326 is carried separately)."""
    return F.format_string("POINT(%s %s)", _col(lon).cast("string"), _col(lat).cast("string"))


def _double_hex(c) -> Column:
    """The 8 bytes of a double, lowest first, as 16 hex digits."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), _col(c).cast("double")).cast("bigint")
    digits = F.lpad(F.hex(bits), 16, "0")
    return F.concat(*[F.substring(digits, 15 - 2 * k, 2) for k in range(8)])


def point_wkb(lon, lat, srid: int = 4326) -> Column:
    """Little-endian well-known-binary point with its SRID; null without both coordinates."""
    head = b"\x01" + (0x20000001).to_bytes(4, "little") + srid.to_bytes(4, "little")
    wkb = F.unhex(F.concat(F.lit(head.hex()), _double_hex(lon), _double_hex(lat)))
    return F.when(_col(lon).isNotNull() & _col(lat).isNotNull(), wkb)


def current_hour(zone: str | None = None) -> Column:
    """Wall-clock hour, evaluated once per query/batch, in ``zone`` (such as
    ``America/Denver``; default: the session's time zone)."""
    if zone is None:
        return F.hour(F.current_timestamp())
    return F.hour(F.convert_timezone(F.current_timezone(), F.lit(zone), F.current_timestamp().cast("timestamp_ntz")))
