"""Scalar Column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c) -> Column:
    """Money as exact integer cents, so sums do not depend on summation order."""
    return F.round(_col(c) * 100).cast("bigint")


def joined_text(sep: str, *cols) -> Column:
    """All fields as text joined by ``sep``; a null keeps its place as ``null``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols])


def tuple_text(*cols) -> Column:
    """Render a row the way a tuple prints: ``(a,b,c)``, a null as ``null``."""
    return F.concat(F.lit("("), joined_text(",", *cols), F.lit(")"))


def fill_missing(value, present, fill: str = "NULL") -> Column:
    """Fill only where the *side* is missing (``present`` is null), never a
    null inside a matched row."""
    return F.when(_col(present).isNull(), F.lit(fill)).otherwise(_col(value).cast("string"))


def event_time(c) -> Column:
    """Event-time column usable by ``withWatermark``.

    Epoch milliseconds become a timestamp; ``timestamp_ntz`` (how parquet
    timestamps without zone are read) is reinterpreted in the session zone,
    which flowlab pins to UTC.
    """
    col = _col(c)
    return col.cast("timestamp")


def millis_to_time(c) -> Column:
    """Epoch milliseconds (the reference's ``f0``) to a timestamp."""
    return F.timestamp_millis(_col(c))
