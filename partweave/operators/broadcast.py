"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Budget for one broadcast side, in estimated in-memory bytes.
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

# From so many rows on, the smaller side of a shuffle join is hashed and the other not sorted.
HASHED_ROWS = 1_000_000


_VARIABLE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def row_bytes(schema: T.StructType) -> int:
    """In-memory width of one row of fixed-width fields (UnsafeRow-like: 8
    bytes per field and 8 of null bits); a text or binary field adds its own bytes."""
    return 8 + 8 * len(schema.fields)


def max_rows_for(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> int:
    """Rows of ``df`` that surely fit ``max_bytes``. 0 where a field has no fixed
    width: a row count alone then proves nothing (``checked_broadcast`` measures it)."""
    if any(isinstance(f.dataType, _VARIABLE) for f in df.schema.fields):
        return 0
    return max(1, max_bytes // row_bytes(df.schema))


def is_at_most(df: DataFrame, n: int) -> bool:
    """True iff ``df`` has at most ``n`` rows.

    ``limit(n + 1).count()`` stops scanning once ``n + 1`` rows are seen, so the
    check costs at most ``n + 1`` rows of work on a scan, not a full pass."""
    return df.limit(n + 1).count() <= n


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES, max_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if its size is proven under budget, else ``df``
    unchanged so the planner / AQE choose a shuffle join from measured sizes.

    Call it on cheap inputs (scans, staged tables, small aggregates); on a lazy
    join the check would run the join."""
    cap = max(1, max_bytes // row_bytes(df.schema))
    if max_rows is not None:
        cap = min(cap, max_rows)
    varying = [f for f in df.schema.fields if isinstance(f.dataType, _VARIABLE)]
    if not varying:
        return F.broadcast(df) if is_at_most(df, cap) else df
    if not all(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in varying):
        return df
    size = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) + 8 for f in varying), F.lit(0))
    found = df.limit(cap + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    fits = found["n"] <= cap and found["n"] * row_bytes(df.schema) + (found["b"] or 0) <= max_bytes
    return F.broadcast(df) if fits else df


def hashed(df: DataFrame, rows: int | None) -> DataFrame:
    """``df``, the right and smaller side of a shuffle join, with a hint for a shuffled hash join if it has
    ``HASHED_ROWS`` or more. Only its share of a partition is then held; the other side streams by. A
    sort-merge join sorts both, and adaptive execution merges partitions by compressed bytes: sorted rows
    take several times that, and spill. Its rows must be about unique by the join's keys."""
    return df.hint("shuffle_hash") if rows is not None and rows >= HASHED_ROWS else df
