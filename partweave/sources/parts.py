"""Scanning a table that arrives as numbered parts, and landing it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bind import SchemaMismatch
from ..operators.columns import cast_ids_by_suffix
from ..session import unsorted_folders
from .csv import NOT_OPENED, list_parts, open_in_task

# Parts whose footers are looked into at once.
LOOKS_AT_ONCE = 16

# Fixed value: file-name pattern of a converted part, ``<table>-<i>-snappy.parquet``.
PART_FILE_PATTERN = r"-(\d+)-snappy\.parquet$"


def part_from_file_name(pattern: str = PART_FILE_PATTERN) -> F.Column:
    """The part number captured by ``pattern`` from each row's file name
    (bigint; NULL when the name does not match)."""
    return F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("long")


def read_parts(
    spark: SparkSession,
    path: str | Sequence[str],
    part: str = "part",
    layout: str = "partitioned",
    pattern: str = PART_FILE_PATTERN,
    schema: T.StructType | None = None,
    check_schemas: bool = True,
) -> DataFrame:
    """All parts of one table as one DataFrame with a ``part`` column.

    ``layout='partitioned'``: ``<path>/part=NN/*.parquet`` - partition
    discovery, and a filter on ``part`` prunes whole directories.
    ``layout='flat'``: files named like ``<table>-<i>-snappy.parquet`` - the
    part is read from each file's name (a data filter, not a pruning one); a
    file with another name is refused. In both layouts all parts must have one
    schema (``check_schemas``, footers only), unless ``schema`` declares it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    r = spark.read.schema(schema) if schema is not None else spark.read
    if layout == "partitioned":
        df = r.parquet(*paths)
        if part not in df.columns:
            raise ValueError(f"no {part}=NN directories under {paths}")
        if check_schemas and schema is None:
            check_part_schemas(spark, list_parts(spark, paths, "(.*)", "*.parquet"))
        return df.withColumn(part, F.col(part).cast("long"))
    if layout == "flat":
        files = list_parts(spark, paths, rf".*?{pattern}", "*.parquet")
        foreign = [r["path"] for r in files.where(F.col("part").isNull()).limit(5).collect()]
        if foreign:
            raise ValueError(f"not named as a part ({pattern}): {foreign}")
        if check_schemas and schema is None:
            check_part_schemas(spark, files)
        df = r.parquet(*paths)
        return df.withColumn(part, part_from_file_name(pattern))
    raise ValueError("layout must be 'partitioned' or 'flat'")


def part_folders(spark: SparkSession, paths: Sequence[str], part: str = "part") -> list[str]:
    """The ``part=NN`` folders under ``paths`` (a row a part comes to the driver, not a file)."""
    files = list_parts(spark, paths, "(.*)", "*.parquet").select(F.regexp_extract("path", rf"^(.*/{part}=[^/]*)/", 1).alias("folder"))
    return [r["folder"] for r in files.where("folder <> ''").distinct().orderBy("folder").collect()]


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and columns of Parquet files, from their footers; the error's name where this task can't open one."""
    for batch in batches:
        rows, shapes, errors = [], [], []
        for path in batch.column(0).to_pylist():
            try:
                with open_in_task(path) as file:
                    footer = pq.read_metadata(file)
                fields = footer.schema.to_arrow_schema()
                rows.append(footer.num_rows)
                shapes.append(", ".join(f"{f.name.lower()} {f.type}" for f in fields))
                errors.append(None)
            except NOT_OPENED as e:
                rows.append(None)
                shapes.append(None)
                errors.append(type(e).__name__)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.int64()), pa.array(shapes, pa.string()), pa.array(errors, pa.string())],
            ["path", "n_rows", "columns", "error"],
        )


def part_footers(files: DataFrame) -> DataFrame:
    """``(path, n_rows, columns, error)`` of the Parquet files in ``files(path)``, as a job: each task reads
    its files' footers, and no data. ``columns`` spells names (lower case) and types in order."""
    return files.select("path").repartition("path").mapInArrow(_footers, "path string, n_rows long, columns string, error string")


def check_part_schemas(spark: SparkSession, files: DataFrame | Sequence[str]) -> None:
    """Refuse parts (a table ``files(path)``, or paths of files or folders) whose files differ in their columns (names ignoring case, types, order).
    Footers only, in one job; the different kinds of columns come to the driver, not the files. Files in a
    store that only Spark's own readers open are compared by one schema read a folder, ``LOOKS_AT_ONCE`` at a time."""
    if not isinstance(files, DataFrame):
        files = list_parts(spark, files, "(.*)", "*.parquet")
    kinds = part_footers(files).groupBy("columns").agg(F.min("path").alias("path"), F.max("error").alias("error")).orderBy("path").limit(3).collect()
    if any(k["error"] for k in kinds):
        folders = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("f"), "path")
        alone = folders.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.collect_list("path").alias("paths")).collect()
        return _check_by_reading(spark, sorted(r["f"] for r in alone) if len(alone) > 1 else sorted(alone[0]["paths"]))
    if len(kinds) > 1:
        raise SchemaMismatch(f"{kinds[1]['path']} has columns {kinds[1]['columns']}, {kinds[0]['path']} has {kinds[0]['columns']}")


def _check_by_reading(spark: SparkSession, paths: Sequence[str]) -> None:
    def schema(path: str) -> T.StructType:
        return spark.read.option("mergeSchema", "true").parquet(path).schema

    first = None
    with ThreadPoolExecutor(LOOKS_AT_ONCE) as ex:
        for p, s in zip(paths, ex.map(schema, paths), strict=True):
            shape = [(f.name.lower(), f.dataType.simpleString()) for f in s.fields]
            if first is None:
                first = shape
            elif shape != first:
                raise SchemaMismatch(f"part {p} has schema {shape}, expected {first}")


def land(df: DataFrame, id_suffix: str = "id", exclude: tuple[str, ...] = ()) -> DataFrame:
    """A landed table: every ``*<id_suffix>`` column (except ``exclude``) as
    bigint."""
    return cast_ids_by_suffix(df, id_suffix, exclude)


def write_parts(df: DataFrame, path: str, part: str = "part", mode: str = "errorifexists") -> None:
    """Write a table partitioned by part (``part=NN/``), Snappy Parquet."""
    with unsorted_folders(df.sparkSession):
        df.write.mode(mode).partitionBy(part).option("compression", "snappy").parquet(path)
