"""Tables created from queries: a stored copy under a catalog name.

``create_table_as`` writes the query's rows once, as a new version in a folder of
its own, and then points the name at it. The name is a catalog view of the
version, and replacing a view is one catalog operation: readers see the old
rows or the new ones, never none or some. A query that fails while it is written leaves
the name as it was. What the query read may be rewritten or deleted afterwards.

Versions stay until ``expire_versions`` or ``drop_table`` deletes them, so a query
that began on an older one can end."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import stage_root

_TABLES_SUBDIR = "partweave-tables"
_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?")

MODES = ("error", "ignore", "replace")


class TableExists(ValueError):
    """The name is taken and neither ``ignore`` nor ``replace`` was asked for."""


def _checked(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"{name!r} is no [database.]table name of letters, digits and underscores")
    return name


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Catalog names of the stored versions, whichever of them the name points at."""
    database, _, table = name.rpartition(".")
    where = f" IN `{database}`" if database else ""
    rows = spark.sql(f"SHOW TABLES{where} LIKE '{table.lower()}__v_*'").collect()  # a row a version
    return [f"{database}.{r['tableName']}" if database else r["tableName"] for r in rows]


def create_table_as(
    spark: SparkSession,
    name: str,
    query: str | DataFrame,
    mode: str = "error",
    partition_by: Sequence[str] = (),
    folder: str | None = None,
) -> DataFrame:
    """``CREATE [OR REPLACE] TABLE [IF NOT EXISTS] name AS query`` and the new table.

    ``mode``: what to do if the name is taken - ``error``, ``ignore`` (keep it) or
    ``replace``. A replaced table may have other columns. The query may read the table it replaces.
    ``folder`` holds the versions; by default one beside the staged tables, which the cluster shares."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    _checked(name)
    if spark.catalog.tableExists(name):
        if mode == "error":
            raise TableExists(name)
        if mode == "ignore":
            return spark.table(name)
        if name.split(".")[-1].lower() not in {t.name.lower() for t in spark.catalog.listTables(name.rpartition(".")[0] or None) if t.tableType == "VIEW"}:
            raise TableExists(f"{name} is a table of another kind")
    version = f"{name.lower()}__v_{uuid.uuid4().hex}"
    root = folder.rstrip("/") if folder else f"{stage_root(spark)}/{_TABLES_SUBDIR}"
    df = spark.sql(query) if isinstance(query, str) else query
    writer = df.write.format("parquet").option("compression", "snappy").option("path", f"{root}/{version}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        _drop_version(spark, version)
        raise
    columns = ", ".join(f"`{c}`" for c in df.columns)  # partition columns are stored last
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT {columns} FROM {_quoted(version)}")
    return spark.table(name)


def current_version(spark: SparkSession, name: str) -> str:
    """Catalog name of the version that ``name`` points at."""
    text = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(_checked(name))}").collect()}["View Text"]
    found = re.search(r"FROM (\S+)$", text)
    return found[1].replace("`", "")


def expire_versions(spark: SparkSession, name: str) -> list[str]:
    """Deletes all versions but the current one; their names."""
    current = current_version(spark, name)
    old = [v for v in _versions(spark, _checked(name)) if v != current]
    for v in old:
        _drop_version(spark, v)
    return old


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    """``DROP TABLE [IF EXISTS]``: the name first, then all its versions and their files."""
    spark.sql(f"DROP VIEW {'IF EXISTS ' if if_exists else ''}{_quoted(_checked(name))}")
    for v in _versions(spark, name):
        _drop_version(spark, v)


def _drop_version(spark: SparkSession, version: str) -> None:
    if not spark.catalog.tableExists(version):
        return
    where = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(version)}").collect()}["Location"]
    spark.sql(f"DROP TABLE {_quoted(version)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
