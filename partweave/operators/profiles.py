"""Profiles of many columns at once.

Exact: values are counted first - one row a distinct value, combined before the
shuffle, so a value in a third of the rows is one row a task. Approximate
percentiles of the same columns bound each quantile to a bracket of a few
ten-thousandths of the rows; what lies below a bracket is one sum, and only the
values inside are ranked. No column is sorted as a whole, and no set of values
meets in one buffer.

Approximate: a distinct-count sketch and a quantile sketch a column, in one scan
and without a shuffle of values. Sketches are kept as a table and can be merged, so
a part that arrives later adds its own without a new scan of the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..functions.types import SQL_TYPE_NAMES
from ..session import stage

PROBS = (0.25, 0.5, 0.75)
QNAMES = ("q25", "q50", "q75")
# Rank error of the bracketing percentiles, as one part in so many rows, and the rows up to
# which a bracket is not worth while. The margin of two errors is more than two ranks above them.
ACCURACY = 10_000
BRACKET_ROWS = 2 * ACCURACY
# Standard error of the distinct count 1.04 / sqrt(2^12) = 1.6 %; rank error of a quantile below 0.7 % (99 %).
HLL_LOG_K = 12
KLL_K = 400

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
_VALUE = ("_l", "_d", "_s")


def type_name(kind: T.DataType) -> str:
    return SQL_TYPE_NAMES.get(kind.simpleString(), kind.simpleString().upper())


def _typed(name: str, kind: T.DataType) -> tuple[Column, Column, Column]:
    """The value as a long, a double or text - whichever keeps it exactly; the others are NULL."""
    c, none = F.col(name), F.lit(None)
    long = c.cast("long") if isinstance(kind, _WHOLE) else none.cast("long")
    double = c.cast("double") if isinstance(kind, (T.FloatType, T.DoubleType)) else none.cast("double")
    text = none.cast("string") if isinstance(kind, (*_WHOLE, T.FloatType, T.DoubleType)) else c.cast("string")
    return long, double, text


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by.., _c, _l, _d, _s, _v, _n)``: each distinct non-NULL value of each column (numbered in
    ``_c``), its number as ``_v`` where it is one, and how many rows have it. One scan for all columns."""
    items = []
    for i, name in enumerate(columns):
        kind = df.schema[name].dataType
        long, double, text = _typed(name, kind)
        number = F.col(name).cast("double") if isinstance(kind, _NUMERIC) else F.lit(None).cast("double")
        items.append((i, name, (long, double, text, number)))
    names = [*_VALUE, "_v"]
    if len(items) == 1:
        i, name, parts = items[0]
        rows = df.where(F.col(name).isNotNull()).select(*by, F.lit(i).alias("_c"), *(p.alias(n) for p, n in zip(parts, names, strict=True)))
    else:
        each = [F.struct(F.lit(i).alias("_c"), *(p.alias(n) for p, n in zip(parts, names, strict=True)), F.col(name).isNotNull().alias("_set")) for i, name, parts in items]
        rows = df.select(*by, F.explode(F.array(*each)).alias("e")).where("e._set").select(*by, "e._c", *(f"e.{n}" for n in names))
    return rows.groupBy(*by, "_c", *names).agg(F.count(F.lit(1)).alias("_n"))


def _base(df: DataFrame, columns: Sequence[str], by: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row a group and column: counts, moments, extremes, and the brackets of the quantiles - or, if
    ``approximate``, the two sketches."""
    aggs = []
    ends = sorted(min(1.0, max(0.0, p + s * 2 / ACCURACY)) for p in PROBS for s in (-1, 1))
    for i, name in enumerate(columns):
        kind, c = df.schema[name].dataType, F.col(name)
        number = isinstance(kind, _NUMERIC)
        d = c.cast("double") if number else F.lit(None).cast("double")
        fields = [
            F.lit(i).alias("_c"),
            F.lit(name).alias("column_name"),
            F.lit(type_name(kind)).alias("column_type"),
            F.count(F.lit(1)).alias("count"),
            F.count(c).alias("_set"),
            *(f(d).alias(n) for f, n in ((F.min, "min_number"), (F.max, "max_number"))),
            *((F.lit(None).cast("string") if number else f(c.cast("string"))).alias(n) for f, n in ((F.min, "min_text"), (F.max, "max_text"))),
        ]
        if len(columns) == 1 and not approximate:
            fields += [F.min(c).alias("min"), F.max(c).alias("max")]
        if approximate:
            whole = c if isinstance(kind, (T.IntegerType, T.LongType, T.StringType)) else c.cast("string")
            fields += [
                F.sum(d).alias("_sum"),
                F.sum(d * d).alias("_squares"),
                F.hll_sketch_agg(whole, F.lit(HLL_LOG_K)).alias("_distinct"),
                F.kll_sketch_agg_double(d, F.lit(KLL_K)).alias("_order"),
            ]
        else:
            bounds = F.percentile_approx(d, ends, ACCURACY) if number else F.lit(None).cast("array<double>")
            fields += [F.avg(d).alias("avg"), F.stddev_samp(d).alias("std"), bounds.alias("_ends")]
        aggs.append(F.struct(*fields))
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(F.array(*aggs).alias("_cols")).select(*by, F.inline("_cols"))


def _ranked(counts: DataFrame, base: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by.., _c, n_unique, q25, q50, q75)`` from value counts and brackets."""
    wanted = [F.struct(F.lit(None).cast("string").alias("_q"), *(F.lit(None).cast(t).alias(n) for t, n in (("long", "_at"), ("double", "_frac"), ("double", "_a"), ("double", "_b"))))]
    many = F.col("_set") > BRACKET_ROWS
    for i, (p, name) in enumerate(zip(PROBS, QNAMES, strict=True)):
        pos = (F.col("_set") - 1) * F.lit(p)
        at = F.floor(pos)
        ends = [F.when(many, F.col("_ends")[2 * i + k]) for k in (0, 1)]
        wanted.append(F.struct(F.lit(name).alias("_q"), at.alias("_at"), (pos - at).alias("_frac"), ends[0].alias("_a"), ends[1].alias("_b")))
    number = F.col("min_number").isNotNull()
    brackets = base.where("_set > 0").select(*by, "_c", F.col("_set").alias("_all"), F.explode(F.when(number, F.array(*wanted)).otherwise(F.array(wanted[0]))).alias("w"))
    brackets = brackets.select(*by, "_c", "_all", "w.*")
    b = F.broadcast(brackets) if not by else brackets  # without groups: four rows a column
    v, k = counts.alias("v"), b.alias("k")
    met = v.join(k, [F.col(f"v.{x}").eqNullSafe(F.col(f"k.{x}")) for x in (*by, "_c")])
    met = met.where(F.col("_q").isNull() | F.col("_b").isNull() | (F.col("_v") <= F.col("_b")))
    # Values inside the bracket stay apart; all those below it are one NULL key.
    inside = F.when(F.col("_q").isNotNull() & (F.col("_a").isNull() | (F.col("_v") >= F.col("_a"))), F.col("_v"))
    keys = [F.col(f"v.{x}").alias(x) for x in (*by, "_c")]
    few = met.groupBy(*keys, "_q", "_at", "_frac", "_all", inside.alias("_key")).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_values"))
    upto = W.partitionBy(*by, "_c", "_q").orderBy(F.col("_key").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    few = few.withColumn("_upto", F.sum("_n").over(upto))
    out = [F.max(F.when(F.col("_q").isNull(), F.col("_values"))).alias("n_unique")]

    def value_at(rank: Column) -> Column:
        missed = F.col("_key").isNull() & F.col("_q").isNotNull()
        found = F.when(missed, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).otherwise(F.col("_key"))
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank), found))

    per_q = few.groupBy(*by, "_c", "_q").agg(
        F.max("_values").alias("_values"),
        value_at(F.col("_at")).alias("_lo"),
        value_at(F.least(F.col("_at") + 1, F.col("_all") - 1)).alias("_hi"),
        F.first("_frac").alias("_frac"),
    )
    quantile = F.round(F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo")), 6)
    out += [F.max(F.when(F.col("_q") == n, quantile)).alias(n) for n in QNAMES]
    return per_q.groupBy(*by, "_c").agg(*out)


#: The two ways to show the extremes: of one column in its own type, of many as numbers and text.
ONE, MANY = ("min", "max"), ("min_number", "max_number", "min_text", "max_text")


def finished(df: DataFrame, by: Sequence[str], extremes: Sequence[str] = MANY) -> DataFrame:
    null = F.round(F.try_divide(F.lit(100.0) * (F.col("count") - F.col("_set")), F.col("count")), 2)
    rounded = [F.round(c, 6).alias(c) for c in ("avg", "std", *QNAMES)]
    return df.select(
        *by, "column_name", "column_type", *extremes, "n_unique", *rounded, "count", null.cast("double").alias("null_percentage")
    )


def profile_table(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), quantiles: str = "exact") -> DataFrame:
    """One row a column (and group of ``by``): column_name, column_type, min_number, max_number,
    min_text, max_text (numbers have the first two, other types the last two), n_unique, avg, std,
    q25, q50, q75 (numbers only, continuous), count, null_percentage.

    ``exact``: two scans of the wanted columns, one for counts and brackets, one for the values.
    ``sketch``: one scan; n_unique has a standard error of 1.6 %, a quantile is a value whose rank
    is within 0.7 % (at 99 %)."""
    by = list(by)
    columns = [c for c in (columns if columns is not None else df.columns) if c not in by]
    if quantiles == "sketch":
        return from_sketches(sketch_columns(df, columns, by), by)
    if quantiles != "exact":
        raise ValueError("quantiles must be 'exact' or 'sketch'")
    return finished(exact_profile(df, columns, by), by)


def exact_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The unrounded exact profile; of one column also ``min`` and ``max`` in its own type."""
    by = list(by)
    base = stage(_base(df, columns, by), "profile-base")
    ranked = _ranked(value_counts(df, columns, by), base, by)
    b, r = base.alias("b"), ranked.alias("r")
    met = b.join(r, [F.col(f"b.{x}").eqNullSafe(F.col(f"r.{x}")) for x in (*by, "_c")], "left")
    picked = [F.col(f"b.{c}").alias(c) for c in base.columns if c not in ("_c", "_ends")]
    return met.select(*picked, F.coalesce("n_unique", F.lit(0)).alias("n_unique"), *QNAMES)


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row a column and group: counts, sums, extremes, and two binary sketches. Store it; rows of
    several tables (parts) go to ``from_sketches`` together."""
    return _base(df, [c for c in (columns if columns is not None else df.columns) if c not in by], list(by), approximate=True)


def from_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The approximate profile of all rows whose sketches are given, merged by column and ``by``."""
    by = list(by)
    n = F.col("_set").cast("double")
    merged = sketches.groupBy(*by, "column_name", "column_type").agg(
        *(F.sum(c).alias(c) for c in ("count", "_set", "_sum", "_squares")),
        *(f(c).alias(c) for c in ("number", "text") for f, c in ((F.min, f"min_{c}"), (F.max, f"max_{c}"))),
        F.hll_sketch_estimate(F.hll_union_agg("_distinct")).alias("n_unique"),
        F.kll_merge_agg_double("_order").alias("_order"),
    )
    spread = (F.col("_squares") - F.col("_sum") * F.col("_sum") / n) / (n - 1)
    some = F.col("min_number").isNotNull()
    return finished(
        merged.withColumns(
            {
                "avg": F.when(some, F.col("_sum") / n),
                "std": F.when(some & (n > 1), F.sqrt(F.greatest(spread, F.lit(0.0)))),
                **{q: F.when(some, F.kll_sketch_get_quantile_double("_order", F.lit(p))) for p, q in zip(PROBS, QNAMES, strict=True)},
            }
        ),
        by,
    )


def union_sketches(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
