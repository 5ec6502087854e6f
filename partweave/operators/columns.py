"""Column-level operators: suffix casts, renames, key-first projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import to_bigint


def id_columns(df: DataFrame, suffix: str = "id", exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns whose name ends with ``suffix``, ignoring case, minus
    ``exclude`` (also case-insensitive). The suffix rule also catches names
    like ``Paid`` or ``Valid``; list such columns in ``exclude``."""
    s = suffix.lower()
    skip = {e.lower() for e in exclude}
    return [c for c in df.columns if c.lower().endswith(s) and c.lower() not in skip]


def cast_ids_by_suffix(df: DataFrame, suffix: str = "id", exclude: tuple[str, ...] = ()) -> DataFrame:
    """Cast every column named ``*<suffix>`` (any case) to bigint; see
    ``to_bigint`` for fractions, NaN and NULL. Other columns pass through."""
    ids = set(id_columns(df, suffix, exclude))
    return df.select(*[to_bigint(c).alias(c) if c in ids else F.col(c) for c in df.columns])


def cast_audit(df: DataFrame, suffix: str = "id", exclude: tuple[str, ...] = (), by: Sequence[str] = ()) -> DataFrame:
    """What ``cast_ids_by_suffix`` does to each ID column, in one pass: (by.., column_name,
    n_rows, n_null, n_lost, n_truncated) - rows, values NULL before the cast, values
    that become NULL in it, and values that lose a fraction."""
    ids = id_columns(df, suffix, exclude)
    one = []
    for c in ids:
        old, new = F.col(c), to_bigint(c)
        cut = new.isNotNull() & (old.try_cast("double") != new.cast("double"))
        one.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(old.isNull()).alias("n_null"),
                F.count_if(old.isNotNull() & new.isNull()).alias("n_lost"),
                F.count_if(cut).alias("n_truncated"),
            )
        )
    if not one:
        kinds = ", ".join(f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by)
        return df.sparkSession.createDataFrame([], f"{kinds + ', ' if by else ''}column_name string, n_rows long, n_null long, n_lost long, n_truncated long")
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(F.array(*one).alias("_audit")).select(*by, F.inline("_audit"))


def rename_orig(df: DataFrame, col: str) -> DataFrame:
    """Rename ``col`` to ``Orig<col>`` in place."""
    return df.withColumnRenamed(col, "Orig" + col)


def key_first(df: DataFrame, key: str) -> DataFrame:
    """``SELECT key, <the rest>``."""
    return df.select(key, *[c for c in df.columns if c != key])
