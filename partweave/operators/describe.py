"""Describe, count and profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import thousands
from ..functions.types import SQL_TYPE_NAMES, sql_type_name
from .profiles import ONE, PROBS, QNAMES, exact_profile, finished


def describe_columns(df: DataFrame) -> DataFrame:
    """(column_name, column_type) of a query, with SQL type names, from its schema."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    d = df.sparkSession.createDataFrame(rows, "column_name string, data_type string")
    return d.select("column_name", sql_type_name(F.col("data_type")).alias("column_type"))


def row_count(df: DataFrame, formatted: bool = False) -> DataFrame:
    """One row, ``count``: bigint, or text with thousands separators."""
    n = F.count(F.lit(1))
    return df.agg((thousands(n) if formatted else n).alias("count"))


def profile_column(
    df: DataFrame,
    col: str,
    quantiles: str = "exact",
    accuracy: int = 10000,
    by: list[str] | None = None,
) -> DataFrame:
    """Profile of a numeric column: column_name, column_type, min, max,
    n_unique (exact distinct count), avg, std,
    q25, q50, q75, count (NULLs included), null_percentage - one row, or one
    row per group of ``by`` (e.g. per part, as after each part's ID
    assignment).

    Quantiles are continuous (linear interpolation between order statistics,
    ``lo + (hi - lo) * frac``). ``quantiles='exact'`` counts distinct values and ranks
    those inside a bracket of each quantile (see ``profiles``), for any number of
    groups. ``'approx'`` uses ``percentile_approx``: one pass, bounded memory, rank
    error about 1/accuracy.
    """
    by = list(by or [])
    c = F.col(col)
    n_all = F.count(F.lit(1))
    type_name = SQL_TYPE_NAMES.get(df.schema[col].dataType.simpleString(), df.schema[col].dataType.simpleString().upper())
    base = [
        F.lit(col).alias("column_name"),
        F.lit(type_name).alias("column_type"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.count_distinct(c).alias("n_unique"),
        F.round(F.avg(c), 6).alias("avg"),
        F.round(F.stddev_samp(c), 6).alias("std"),
    ]
    tail = [
        n_all.alias("count"),
        # NULL, not an error, for an empty input.
        F.round(F.try_divide(F.lit(100.0) * (n_all - F.count(c)), n_all), 2).cast("double").alias("null_percentage"),
    ]
    grouped = df.groupBy(*by) if by else df
    if quantiles == "approx":
        qs = F.percentile_approx(c.cast("double"), list(PROBS), accuracy)
        return grouped.agg(*base, *[F.round(qs[i], 6).alias(nm) for i, nm in enumerate(QNAMES)], *tail)
    if quantiles != "exact":
        raise ValueError("quantiles must be 'exact' or 'approx'")
    return finished(exact_profile(df, [col], by), by, ONE)
