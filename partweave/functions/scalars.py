"""Scalar column functions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of(c: str | Column) -> Column:
    """Calendar year of a date / timestamp as bigint (Spark's ``year`` is int)."""
    return F.year(c).cast("long")


def to_bigint(c: str | Column) -> Column:
    """Number, or text that holds one, to 64-bit integer: truncates toward zero;
    NaN, infinities, out-of-range values and other text become NULL instead of
    failing the job."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.try_cast("long"), col.cast("string").try_cast("decimal(38,6)").try_cast("long"))


def thousands(c: str | Column) -> Column:
    """Integer as text with thousands separators: 1234567 -> '1,234,567'."""
    return F.format_number(c, 0)
