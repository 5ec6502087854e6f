"""Which parts each table has: an inventory, and the (table, part) gaps."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def part_inventory(tables: Mapping[str, DataFrame], part: str = "part") -> DataFrame:
    """One row per part seen in any table, one column per table: its rows in
    that part (0 when the part is missing there).

    Reads only the part column of each table; the pivot values are the table
    names, so the width is fixed by the registry, not by the data."""
    names = list(tables)
    counted = [
        tables[t].groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select(part, F.lit(t).alias("_table"), "_n")
        for t in names
    ]
    allp = reduce(DataFrame.unionByName, counted)
    wide = allp.groupBy(part).pivot("_table", names).agg(F.sum("_n"))
    return wide.select(part, *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(t) for t in names])


def missing_parts(tables: Mapping[str, DataFrame], part: str = "part") -> DataFrame:
    """(table_name, part) pairs where a part present in some table has no rows
    in this one."""
    inv = part_inventory(tables, part)
    names = list(tables)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(t).alias("table_name"), F.col(t).alias("n")) for t in names])
    ).alias("_p")
    return inv.select(part, pairs).where(F.col("_p.n") == 0).select(F.col("_p.table_name").alias("table_name"), part)
