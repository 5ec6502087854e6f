"""Descriptive rollups of claims tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import year_of


def code_year_rollup(
    df: DataFrame,
    code: str,
    code_type: str | None,
    date: str,
    year_name: str = "year",
    count_name: str = "count",
    code_alias: str | None = None,
    code_type_alias: str | None = None,
    sort: str | None = None,
) -> DataFrame:
    """Rows per (code, code type, calendar year of ``date``); NULL is a group.

    ``sort``: None (unordered), ``'nulls_last'`` or ``'nulls_first'`` ascending
    by year - the two conventions of the frame APIs the rollup is written in.
    Partial aggregation runs before the shuffle, so only one row per group and
    map task crosses the network.
    """
    keys = [F.col(code).alias(code_alias or code)]
    if code_type:
        keys.append(F.col(code_type).alias(code_type_alias or code_type))
    keys.append(year_of(date).alias(year_name))
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    if sort == "nulls_last":
        out = out.orderBy(F.col(year_name).asc_nulls_last())
    elif sort == "nulls_first":
        out = out.orderBy(F.col(year_name).asc_nulls_first())
    elif sort is not None:
        raise ValueError("sort must be None, 'nulls_last' or 'nulls_first'")
    return out


def coverage_count(
    people: DataFrame,
    spans: DataFrame,
    on: Sequence[str] | str | Column,
    by: Sequence[str],
    flags: dict[str, str],
    count_name: str = "count",
    distinct_people: str | None = None,
) -> DataFrame:
    """Joined span rows per demographic group where every flag column of
    ``spans`` equals its value (``MedCov='Y' AND DrugCov='Y'``).

    ``count`` counts spans, as the SQL it stands for does; pass
    ``distinct_people=<id column>`` for a patient count as well. The flag
    filter is applied to ``spans`` before the join and reaches its scan.
    """
    if isinstance(on, str):
        on = [on]
    elif not isinstance(on, Column):
        on = list(on)
    cond = None
    for col, val in flags.items():
        term = F.col(col) == F.lit(val)
        cond = term if cond is None else cond & term
    s = spans.where(cond) if cond is not None else spans
    j = people.join(s, on)
    aggs = [F.count(F.lit(1)).alias(count_name)]
    if distinct_people:
        aggs.append(F.count_distinct(distinct_people).alias("n_people"))
    return j.groupBy(*by).agg(*aggs)
