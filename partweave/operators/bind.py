"""Binding parts into one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


class SchemaMismatch(ValueError):
    pass


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in df.schema.fields]


def union_parts(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by position (``UNION ALL``), after checking that every frame
    has the same column names (case-insensitive) and types in the same order.
    Spark's own ``union`` would silently coerce a string column against a
    bigint one."""
    if not frames:
        raise ValueError("nothing to bind")
    first = _shape(frames[0])
    for i, f in enumerate(frames[1:], start=2):
        if _shape(f) != first:
            raise SchemaMismatch(f"frame {i} has schema {_shape(f)}, expected {first}")
    return reduce(DataFrame.union, frames)


def bind(df: DataFrame, part: str = "part", columns: Sequence[str] | None = None) -> DataFrame:
    """One table from all parts: drop the part column (IDs are global after the
    rebase), optionally putting the columns in a declared order."""
    out = df.drop(part)
    return out.select(*columns) if columns else out


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", max_records_per_file: int | None = None) -> None:
    """Snappy Parquet. Write each run to a new path: overwriting a path the
    plan still reads from deletes its own input. ``max_records_per_file``
    caps file size when a task writes many rows (files are split, no row is
    dropped)."""
    w = df.write.mode(mode).option("compression", "snappy")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)
