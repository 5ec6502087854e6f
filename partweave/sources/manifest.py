"""Landing with a manifest: which parts are in, with what rows, types and losses.

A part is landed when its row stands in the manifest. Its files are written first, the row
after them in one commit; so a run that is cut leaves no half part that counts, and a repeated
run writes the parts that have no row yet and adds nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import cast_audit, cast_ids_by_suffix
from ..session import stage, unsorted_folders
from .parts import read_parts

_LOSS = T.StructType([T.StructField(n, t) for n, t in (("column_name", T.StringType()), ("n_null", T.LongType()), ("n_lost", T.LongType()), ("n_truncated", T.LongType()))])
SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("schema", T.StringType()),
        T.StructField("losses", T.ArrayType(_LOSS)),
    ]
)


class SchemaChanged(ValueError):
    """A new part's landed columns differ from those of the parts in the manifest."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs
    to = hadoop.Path(path)
    if not to.getFileSystem(spark._jsc.hadoopConfiguration()).exists(to):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def land_new_parts(
    raw: DataFrame,
    table: str,
    path: str,
    manifest: str,
    id_suffix: str = "id",
    exclude: Sequence[str] = (),
    part: str = "part",
) -> DataFrame:
    """Lands the parts of ``raw`` that ``manifest`` does not have yet as ``<path>/part=NN/`` and
    appends their rows to it; these rows. Files that a cut run left of such a part are replaced."""
    spark = raw.sparkSession
    exclude = tuple(exclude)
    # Staged, as the folder grows below and scans of one path count as the same (see the ledger).
    known = stage(read_manifest(spark, manifest).where(F.col("table_name") == table), "manifest-known")
    landed = cast_ids_by_suffix(raw, id_suffix, exclude)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in landed.schema.fields if f.name != part)
    other = known.where(F.col("schema") != ddl).select("part", "schema").first()
    if other:
        raise SchemaChanged(f"{table}: part {other['part']} has {other['schema']}, the new parts {ddl}")
    done = known.select(F.col("part").alias(part))  # a row a part
    todo = raw.join(F.broadcast(done), part, "left_anti")
    # The audit reads the raw rows once more; only it sees what the cast loses.
    audit = cast_audit(todo, id_suffix, exclude, by=[part])
    audit = audit.groupBy(part).agg(F.max("n_rows").alias("n_rows"), F.array_sort(F.collect_list(F.struct(*_LOSS.fieldNames()))).alias("losses"))
    with unsorted_folders(spark):
        cast_ids_by_suffix(todo, id_suffix, exclude).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
            "compression", "snappy"
        ).partitionBy(part).parquet(path)
    found = todo.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))
    f, a = found.alias("f"), audit.alias("a")
    rows = f.join(a, F.col(f"f.{part}").eqNullSafe(F.col(f"a.{part}")), "left").select(
        F.lit(table).alias("table_name"),
        F.col(f"f.{part}").cast("long").alias("part"),
        "f.n_rows",
        F.lit(ddl).alias("schema"),
        F.coalesce("a.losses", F.array().cast(SCHEMA["losses"].dataType)).alias("losses"),
    )
    rows = stage(rows, "manifest-rows")
    if not rows.isEmpty():
        rows.coalesce(1).write.mode("append").parquet(manifest)
    return rows


def read_landed(spark: SparkSession, path: str, manifest: str, table: str, part: str = "part") -> DataFrame:
    """The landed rows of the parts in the manifest."""
    known = stage(read_manifest(spark, manifest).where(F.col("table_name") == table).select(F.col("part").alias(part)), "manifest-known")
    return read_parts(spark, path, part).join(F.broadcast(known), part, "left_semi")


def losses(spark: SparkSession, manifest: str) -> DataFrame:
    """``(table_name, part, column_name, n_rows, n_null, n_lost, n_truncated)`` of the landed parts."""
    rows = read_manifest(spark, manifest).select("table_name", "part", "n_rows", F.inline("losses"))
    return rows.select("table_name", "part", "column_name", "n_rows", "n_null", "n_lost", "n_truncated")
