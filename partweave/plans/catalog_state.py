"""Registered queries over stored state: created tables, the ledger, the manifest, and over the
histogram, value-count and compact forms of the claims operators. Merged into ``catalog``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.compact import compact_key_map
from ..operators.ids import key_map, rebase_ids
from ..operators.keys import rewrite_fk
from ..operators.numbering import number_rows
from ..operators.profiles import profile_table
from ..operators.tables import create_table_as, drop_table, expire_versions
from ..session import new_stage_path
from ..sources.csv import list_parts
from ..sources.manifest import land_new_parts, losses, read_landed
from ..sources.parts import part_footers, write_parts
from ..streaming.ledger import Ledger, rebase_new_parts, rebase_stream
from .fixtures import fixture, read_table


def q_ctas_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT: the rows stay when the table is replaced from itself and
    its source is rewritten afterwards."""
    name, src = "pw_ctas_orders", new_stage_path(spark, "ctas-src")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    orders.write.parquet(src)
    drop_table(spark, name)
    create_table_as(spark, name, f"SELECT * FROM parquet.`{src}`")
    create_table_as(spark, name, f"SELECT o_orderkey, o_custkey AS Origo_custkey, o_totalprice FROM {name} WHERE o_orderstatus <> 'P'", mode="replace")
    orders.limit(1).write.mode("overwrite").parquet(src)
    expire_versions(spark, name)
    return spark.table(name)


def q_profile_table(spark: SparkSession, d: str) -> DataFrame:
    """Exact profile of every column of orders: keys, text, money and dates, in two scans."""
    return profile_table(read_table(spark, d, "orders"))


def q_rebase_patid_segments(spark: SparkSession, d: str) -> DataFrame:
    return rebase_ids(fixture(spark, d).demo_src, "PatID", method="segments")


def q_number_orders_segments(spark: SparkSession, d: str) -> DataFrame:
    """Orders numbered by date and key, from an exact histogram of the key in each day."""
    orders = read_table(spark, d, "orders").select("o_orderdate", "o_orderkey")
    return number_rows(orders, ["o_orderdate", "o_orderkey"], "new_id", method="segments")


def q_rebase_in_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """Parts 1 to 3, then 4 and 5, through one ledger; the first run is repeated."""
    demo, ledger = fixture(spark, d).demo_src, Ledger(spark, new_stage_path(spark, "ledger"))
    rebase_new_parts(demo.where("part <= 3"), "PatID", ledger, "demographic")
    first = rebase_new_parts(demo.where("part <= 3"), "PatID", ledger, "demographic")
    return first.unionByName(rebase_new_parts(demo.where("part > 3"), "PatID", ledger, "demographic"))


def q_rebase_part_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same as micro-batches over a folder that grows between two starts of the query."""
    demo, ledger = fixture(spark, d).demo_src, Ledger(spark, new_stage_path(spark, "ledger"))
    src, out, place = (new_stage_path(spark, f"rebase-{x}") for x in ("src", "out", "ckpt"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in demo.schema.fields)
    for some in ("part <= 3", "part > 3"):
        demo.where(some).write.mode("append").partitionBy("part").parquet(src)
        stream = spark.readStream.schema(kinds).parquet(src)
        rebase_stream(stream, "PatID", ledger, "demographic", out, checkpoint=place).awaitTermination()
    done = spark.read.parquet(out)
    return done.select(F.col("part").cast("long").alias("part"), *(c for c in done.columns if c != "part"))


def _enrollment(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    fx = fixture(spark, d)
    return fx.enroll_src, key_map(rebase_ids(fx.demo_src, "PatID"), "PatID")


def q_rewrite_fk_compact(spark: SparkSession, d: str) -> DataFrame:
    """The key rewrite through a key map packed into blocks."""
    child, km = _enrollment(spark, d)
    return compact_key_map(km, "PatID").rewrite(child).select("PatID", "part", "MedCov", "DrugCov")


def q_rewrite_fk_prefiltered(spark: SparkSession, d: str) -> DataFrame:
    """The key rewrite as a shuffle join, orphans dropped at the child's scan."""
    child, km = _enrollment(spark, d)
    return rewrite_fk(child, km, "PatID", broadcast="never", prefilter=True).select("PatID", "part", "MedCov", "DrugCov")


def q_land_with_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Parts landed in two runs, the second over all of them, and a third that has nothing to do."""
    raw = fixture(spark, d).enroll_src.withColumn("PatID", F.col("PatID").cast("double"))
    path, manifest = new_stage_path(spark, "landed"), new_stage_path(spark, "manifest")
    land_new_parts(raw.where("part <= 2"), "enrollment", path, manifest)
    for _ in range(2):
        land_new_parts(raw, "enrollment", path, manifest)
    return read_landed(spark, path, manifest, "enrollment").select("part", "PatID", "MedCov", "DrugCov")


def q_part_footers(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each landed part and whether all its files have the same columns, from the footers alone."""
    path = new_stage_path(spark, "landed")
    write_parts(fixture(spark, d).enroll_src, path)
    found = part_footers(list_parts(spark, path, "(.*)", "*.parquet"))
    part = F.regexp_extract("path", "/part=([0-9]+)/", 1).cast("long")
    one_kind = F.min("columns").eqNullSafe(F.max("columns")) & F.min("columns").isNotNull()
    return found.groupBy(part.alias("part")).agg(F.sum("n_rows").alias("n_rows"), one_kind.alias("one_kind"))


def q_cast_losses(spark: SparkSession, d: str) -> DataFrame:
    """What the landing cast loses, per part and ID column: fractions, NaN, text that is no number."""
    part = F.col("l_linenumber").cast("long")
    raw = read_table(spark, d, "lineitem").select(
        part.alias("part"),
        F.when(part == 2, F.col("l_partkey") + 0.5).when(F.col("l_returnflag") == "A", F.lit(float("nan"))).otherwise(F.col("l_partkey").cast("double")).alias("PatID"),
        F.when(part == 3, F.col("l_returnflag")).when(part == 4, F.lit(None)).otherwise(F.col("l_suppkey").cast("string")).alias("ProviderID"),
        F.col("l_shipdate").alias("ADate"),
    )
    path, manifest = new_stage_path(spark, "landed"), new_stage_path(spark, "manifest")
    land_new_parts(raw, "dispensing", path, manifest)
    return losses(spark, manifest)


def _profile_sql(column: str, kind: str) -> str:
    number = kind in ("BIGINT", "INTEGER", "DOUBLE")
    none, text = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    low, high = (f"CAST({f}({column}) AS DOUBLE)" if number else none for f in ("min", "max"))
    low_text, high_text = (text if number else f"CAST({f}({column}) AS VARCHAR)" for f in ("min", "max"))
    moments = (f"round(avg({column}), 6)", f"round(stddev_samp({column}), 6)") if number else (none, none)
    quantiles = [f"round(quantile_cont({column}, {q}), 6)" if number else none for q in (0.25, 0.5, 0.75)]
    return (
        f"SELECT '{column}' AS column_name, '{kind}' AS column_type, {low} AS min_number, {high} AS max_number, "
        f"{low_text} AS min_text, {high_text} AS max_text, count(DISTINCT {column}) AS n_unique, {moments[0]} AS avg, {moments[1]} AS std, "
        f"{quantiles[0]} AS q25, {quantiles[1]} AS q50, {quantiles[2]} AS q75, count(*) AS count, "
        f"round(100.0 * (count(*) - count({column})) / count(*), 2)::DOUBLE AS null_percentage FROM orders"
    )


_ORDERS = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ctas_snapshot": q_ctas_snapshot,
    "profile_table": q_profile_table,
    "rebase_patid_segments": q_rebase_patid_segments,
    "number_orders_segments": q_number_orders_segments,
    "rebase_in_two_runs": q_rebase_in_two_runs,
    "rebase_part_stream": q_rebase_part_stream,
    "rewrite_fk_compact": q_rewrite_fk_compact,
    "rewrite_fk_prefiltered": q_rewrite_fk_prefiltered,
    "land_with_manifest": q_land_with_manifest,
    "cast_losses": q_cast_losses,
    "part_footers": q_part_footers,
}

# Queries whose answer is that of another registered query.
SAME_AS = {
    "rebase_patid_segments": "rebase_patid",
    "rebase_in_two_runs": "rebase_patid",
    "rebase_part_stream": "rebase_patid",
    "rewrite_fk_compact": "rewrite_fk_enrollment",
    "rewrite_fk_prefiltered": "rewrite_fk_enrollment",
    "land_with_manifest": "land_parts",
}

ORACLES: dict[str, str] = {
    "ctas_snapshot": "SELECT o_orderkey, o_custkey AS Origo_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
    "profile_table": " UNION ALL ".join(_profile_sql(c, t) for c, t in _ORDERS.items()),
    "number_orders_segments": "SELECT o_orderdate, o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS new_id FROM orders",
    "cast_losses": """
WITH raw AS (
  SELECT CAST(l_linenumber AS BIGINT) AS part, l_linenumber = 2 AS half, l_linenumber <> 2 AND l_returnflag = 'A' AS nan FROM lineitem)
SELECT 'dispensing' AS table_name, part, 'PatID' AS column_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_null,
       count(*) FILTER (nan) AS n_lost, count(*) FILTER (half) AS n_truncated FROM raw GROUP BY part
UNION ALL
SELECT 'dispensing', part, 'ProviderID', count(*), count(*) FILTER (part = 4), count(*) FILTER (part = 3), CAST(0 AS BIGINT) FROM raw GROUP BY part
""",
}
