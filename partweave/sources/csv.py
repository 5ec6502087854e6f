"""CSV readers: declared schema (the production path), inferred schema, and
a SQL temp view over a CSV path. One dialect for reading and writing: fields in
double quotes, a quote inside a field doubled (RFC 4180)."""

from __future__ import annotations

import csv as _csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bind import SchemaMismatch


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    header: bool = True,
    multi_line: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """With ``schema``: no inference pass, types as declared; every file's header must
    name the schema's columns in its order, else the read fails. Without: one
    extra pass over the data to infer types. ``multi_line`` allows newlines inside
    quoted fields (a file is then read by one task). ``glob`` picks files of a folder by name."""
    r = spark.read.options(**({"pathGlobFilter": glob} if glob else {})).option("header", str(header).lower()).option("escape", '"').option("multiLine", str(multi_line).lower())
    paths = [path] if isinstance(path, str) else list(path)
    if schema is not None:
        return r.option("enforceSchema", str(not header).lower()).schema(schema).csv(paths)
    return r.option("inferSchema", "true").csv(paths)


def csv_view(spark: SparkSession, name: str, path: str, header: bool = True, schema_ddl: str | None = None) -> DataFrame:
    """``CREATE OR REPLACE TEMP VIEW name USING csv`` and return the view."""
    cols = f"({schema_ddl}) " if schema_ddl else ""
    infer = "false" if schema_ddl else "true"
    enforce = "false" if schema_ddl and header else "true"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} {cols}USING csv "
        f"OPTIONS (path '{path}', header '{str(header).lower()}', inferSchema '{infer}', "
        f"enforceSchema '{enforce}', escape '\"')"
    )
    return spark.table(name)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", str(header).lower()).option("escape", '"').csv(path)


def list_parts(spark: SparkSession, path: str | Sequence[str], pattern: str, glob: str | None = None) -> DataFrame:
    """``(part, path, file_name, bytes)`` of the files under ``path``, as a table: a binary-file scan
    that selects no content lists files and opens none. ``part`` is the first group of
    ``pattern`` on the whole name, NULL for other names."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    r = r.option("pathGlobFilter", glob) if glob else r
    name = F.element_at(F.split("path", "/"), -1)
    number = F.regexp_extract(name, f"^(?:{pattern})$", 1).try_cast("long")
    return r.load([path] if isinstance(path, str) else list(path)).select(number.alias("part"), "path", name.alias("file_name"), F.col("length").alias("bytes"))


def read_csv_parts(
    spark: SparkSession,
    directory: str,
    table: str,
    schema: T.StructType | None = None,
    header: bool = True,
    part: str = "part",
    multi_line: bool = False,
) -> DataFrame:
    """All ``<table>_<i>.csv`` extracts of one table, read by Spark's own CSV
    reader (JVM-side, large files split across tasks), with ``part`` taken
    from each row's file name.

    Columns are bound by header name: parts may order their columns
    differently, and files with one header are one scan. Headers are read by one job over
    all files. Every part must name the
    same columns (ignoring case); a column more or fewer is refused. Types come
    from ``schema``; without it every column is text, so nothing is lost to a guess
    (leading zeros). Without a header line a ``schema`` is needed and binds by position."""
    pattern = rf"{re.escape(table)}_(\d+)\.csv"
    glob = f"{table}_*.csv"
    number = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).cast("long")
    # Other names belong to other tables and are left alone.
    files = list_parts(spark, directory, pattern, glob).where(F.col("part").isNotNull())
    twice = files.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).where("n > 1").first()
    if twice:
        raise SchemaMismatch(f"{twice['n']} files for part {twice['part']}, one is {twice['path']}")
    heads = _heads(spark, directory, pattern, glob) if header else None
    if header:
        kinds = heads.collect()  # a row a different header, not a file
        if any(k["head"] is None for k in kinds):
            kinds = _heads(spark, directory, pattern, glob, opened=False).collect()
        found = [tuple(next(_csv.reader([k["head"]]))) if k["head"] else () for k in kinds]
    elif schema is None:
        raise ValueError("files without a header line need a schema")
    if files.isEmpty():
        raise FileNotFoundError(f"no file named like {pattern} in {directory}")
    if not header:
        paths = [r["path"] for r in files.select("path").collect()]
        return read_csv(spark, paths, schema, header=False, multi_line=multi_line).withColumn(part, number)
    names = schema.fieldNames() if schema is not None else list(found[0])
    fields = {n.lower(): schema[n] if schema is not None else T.StructField(n, T.StringType()) for n in names}
    # Where one glob names just the parts' files and all have one header, Spark lists them; else they are named.
    narrow = f"{table}_[0-9]*.csv"
    plain = len(kinds) == 1 and list_parts(spark, directory, pattern, narrow).where(F.col("part").isNull()).isEmpty()
    frames = []
    for kind, head in zip(kinds, found, strict=True):
        if sorted(h.lower() for h in head) != sorted(fields):
            raise SchemaMismatch(f"{kind['first_path']} has columns {list(head)}, expected {names}")
        own = T.StructType([T.StructField(h, fields[h.lower()].dataType) for h in head])
        files = {"path": directory, "glob": narrow} if plain else {"path": kind["paths"]}
        df = read_csv(spark, **files, schema=own, multi_line=multi_line).withColumn(part, number)
        frames.append(df.select(*[F.col(n).alias(n) for n in names], part))
    return reduce(DataFrame.unionAll, frames)


def open_in_task(path: str) -> pa.NativeFile:
    """A file by its path, in a task: for a few bytes of it, where Spark has no scan that reads only these."""
    where = re.sub("^file:/+", "/", path)
    fs, inside = (pa_fs.LocalFileSystem(), where) if where.startswith("/") else pa_fs.FileSystem.from_uri(where)
    return fs.open_input_file(inside)


#: What ``open_in_task`` raises for a store that it can't open, or that has no such file.
NOT_OPENED = (OSError, pa.ArrowException, ImportError)


def _opened_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file; NULL where this task can't open it."""
    for batch in batches:
        heads = []
        for path in batch.column(0).to_pylist():
            try:
                with open_in_task(path) as file:
                    line = b""
                    while b"\n" not in line and (more := file.read(1 << 14)):
                        line += more
                heads.append(line.split(b"\n", 1)[0].decode().removesuffix("\r"))
            except NOT_OPENED:
                heads.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.string())], ["path", "head"])


def _scanned_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file that begins in this task."""
    seen: set[str] = set()
    for batch in batches:
        for path, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if start == 0 and path not in seen:
                seen.add(path)
                yield pa.RecordBatch.from_pydict({"path": [path], "head": [line]})


def _heads(spark: SparkSession, directory: str, pattern: str, glob: str, opened: bool = True) -> DataFrame:
    """``(head, first_path, paths)``: the different header lines and the files that have them. Each task opens
    its files for their first lines; where that fails (a store that only Spark's readers open), one scan
    of all lines finds them."""
    if opened:
        files = list_parts(spark, directory, pattern, glob).where(F.col("part").isNotNull()).select("path")
        heads = files.repartition("path").mapInArrow(_opened_heads, "path string, head string")
    else:
        lines = spark.read.option("pathGlobFilter", glob).text(directory)
        named = F.regexp_extract(F.col("_metadata.file_name"), f"^(?:{pattern})$", 1) != ""
        lines = lines.where(named).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
        )
        heads = lines.where("start = 0").mapInArrow(_scanned_heads, "path string, head string")
    clean = F.regexp_replace("head", "^\ufeff", "")
    by = heads.groupBy(clean.alias("head")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    return by.select("head", F.col("paths")[0].alias("first_path"), "paths").orderBy("first_path")
