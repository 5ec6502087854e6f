"""End-to-end conversion: numbered extracts -> landed parts -> integrated,
bound tables.

    land_tables(spark, "data/", "landing/", fmt="sas7bdat")   # part=NN/ per table
    integrate("landing/", "output/")                           # rebase, rewrite, bind, write

Each step writes to a new folder and never over its input.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..registry import CLAIMS, Registry
from ..sources.csv import read_csv_parts
from ..sources.manifest import land_new_parts, read_landed
from ..sources.parts import land, read_parts, write_parts
from ..session import drop_stages
from ..sources.sas import register
from .pipeline import Pipeline


# Beside the tables' folders; Spark's own readers pass over names that begin so.
MANIFEST = "_manifest"


def read_extract(spark: SparkSession, source_dir: str, table: str, fmt: str = "sas7bdat", chunk_rows: int = 100_000, schema: T.StructType | None = None) -> DataFrame:
    """All ``<table>_<i>.<ext>`` extracts of one table. CSV goes through
    Spark's CSV reader (split across tasks), as text unless ``schema`` says more; SAS formats through the
    ``sasparts`` source, one task per file."""
    if fmt == "csv":
        return read_csv_parts(spark, source_dir, table, schema)
    register(spark)
    return (
        spark.read.format("sasparts")
        .option("path", source_dir)
        .option("table", table)
        .option("format", fmt)
        .option("chunk_rows", str(chunk_rows))
        .load()
    )


def land_tables(
    spark: SparkSession,
    source_dir: str,
    landing_dir: str,
    registry: Registry = CLAIMS,
    fmt: str = "sas7bdat",
    tables: Iterable[str] | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
    exclude: tuple[str, ...] = (),
    manifest: bool = False,
) -> dict[str, str]:
    """Land every table: decode its extracts, cast ``*id`` columns (except
    ``exclude``) to bigint, write ``<landing_dir>/<table>/part=NN/``. Returns the
    paths written. CSV columns without a type in ``schemas`` land as text; a cast
    that would lose values shows in ``operators.columns.cast_audit`` of the extract.

    ``manifest``: only parts that ``<landing_dir>/_manifest`` does not have yet are landed, and entered with their
    rows, types and losses (``sources.manifest``); so a landing can be repeated, extended, and resumed."""
    out = {}
    root = landing_dir.rstrip("/")
    for t in tables or registry.tables:
        raw = read_extract(spark, source_dir, t, fmt, schema=(schemas or {}).get(t))
        out[t] = f"{root}/{t}"
        if manifest:
            land_new_parts(raw, t, out[t], f"{root}/{MANIFEST}", registry.id_suffix, exclude, registry.part)
        else:
            write_parts(land(raw, registry.id_suffix, exclude), out[t], registry.part)
    return out


def read_landing(
    spark: SparkSession, landing_dir: str, registry: Registry = CLAIMS, tables: Iterable[str] | None = None, manifest: bool = False
) -> dict[str, DataFrame]:
    """The landed tables; with ``manifest`` only the parts entered there."""
    root = landing_dir.rstrip("/")
    if manifest:
        return {t: read_landed(spark, f"{root}/{t}", f"{root}/{MANIFEST}", t, registry.part) for t in (tables or registry.tables)}
    return {t: read_parts(spark, f"{root}/{t}", registry.part) for t in (tables or registry.tables)}


def integrate(
    spark: SparkSession,
    landing_dir: str,
    out_dir: str,
    registry: Registry = CLAIMS,
    tables: Iterable[str] | None = None,
    max_records_per_file: int | None = None,
    drop_staged: bool = False,
    manifest: bool = False,
    **pipeline_options,
) -> dict[str, str]:
    """Rebase owners, rewrite keys, bind and write every landed table.
    ``drop_staged`` then deletes everything this application has staged: only for
    an application that does nothing else, like the command line."""
    p = Pipeline(read_landing(spark, landing_dir, registry, tables, manifest), registry, **pipeline_options)
    paths = p.write(out_dir, max_records_per_file=max_records_per_file)
    if drop_staged:
        drop_stages(spark)
    return paths
