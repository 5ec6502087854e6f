"""Registered queries: a Spark builder and an equivalent DuckDB oracle each.

Every builder takes (spark, sf_dir) and returns a DataFrame over the given
tables (or over the overlapping-parts fixture Spark derives from them).
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bind import bind, union_parts
from ..operators.columns import cast_ids_by_suffix, rename_orig
from ..operators.describe import describe_columns, profile_column, row_count
from ..operators.ids import check_ids, fan_out, key_map, part_counts, part_offsets, rebase_ids
from ..operators.keys import orphans
from ..operators.parts import part_inventory
from ..operators.rollups import code_year_rollup, coverage_count
from ..session import new_stage_path, stage, unsorted_folders
from ..registry import CLAIMS, ForeignKey, Registry
from ..sources.csv import csv_view, read_csv, read_csv_parts, write_csv
from ..sources.parts import land, part_folders, read_parts, write_parts
from ..streaming.landing import land_stream
from .catalog_state import ORACLES as STATE_ORACLES
from .catalog_state import QUERIES as STATE_QUERIES
from .catalog_state import SAME_AS
from .convert import integrate
from .fixtures import fixture, read_table
from .pipeline import Pipeline

Query = Callable[[SparkSession, str], DataFrame]

_PIPELINES: dict[tuple[str, str], Pipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PIPELINES:
        _PIPELINES[key] = Pipeline(fixture(spark, sf_dir).tables())
    return _PIPELINES[key]


# -- descriptive surface over the driver tables ------------------------------

def q_scan_table(spark, d):
    return read_table(spark, d, "region").select("*")


def q_row_count(spark, d):
    return row_count(read_table(spark, d, "lineitem"))


def q_row_count_formatted(spark, d):
    return row_count(read_table(spark, d, "lineitem"), formatted=True)


def q_describe_columns(spark, d):
    return describe_columns(read_table(spark, d, "orders"))


def q_code_year_rollup(spark, d):
    li = read_table(spark, d, "lineitem")
    return code_year_rollup(li, "l_returnflag", "l_linestatus", "l_shipdate", code_alias="DX", code_type_alias="DX_codetype")


def q_code_year_rollup_sql(spark, d):
    read_table(spark, d, "lineitem").createOrReplaceTempView("pw_lineitem")
    return spark.sql(
        "SELECT l_returnflag AS DX, l_linestatus AS DX_codetype, CAST(year(l_shipdate) AS BIGINT) AS year, "
        "count(*) AS count FROM pw_lineitem GROUP BY l_returnflag, l_linestatus, year(l_shipdate)"
    )


def q_code_year_rollup_sorted(spark, d):
    ev = read_table(spark, d, "events")
    return code_year_rollup(ev, "event_type", None, "ts", year_name="Year", count_name="n", code_alias="PX", sort="nulls_last")


def q_coverage_count(spark, d):
    c = read_table(spark, d, "customer")
    o = read_table(spark, d, "orders")
    return coverage_count(
        c,
        o,
        on=c.c_custkey == o.o_custkey,
        by=[F.col("c_mktsegment").alias("Sex"), F.col("c_nationkey").alias("Race")],
        flags={"o_orderstatus": "F", "o_orderpriority": "1-URGENT"},
    )


def q_profile_column(spark, d):
    return profile_column(read_table(spark, d, "orders"), "o_custkey")


def q_cast_ids_by_suffix(spark, d):
    return cast_ids_by_suffix(read_table(spark, d, "customer"), suffix="key")


def q_rename_drop(spark, d):
    o = rename_orig(read_table(spark, d, "orders"), "o_custkey")
    return o.drop("o_orderstatus", "o_orderdate", "o_orderpriority")


def q_csv_roundtrip(spark, d):
    nation = read_table(spark, d, "nation")
    path = new_stage_path(spark, "csv-nation")
    write_csv(nation, path)
    return read_csv(spark, path, schema=nation.schema)


def q_csv_inferred_roundtrip(spark, d):
    nation = read_table(spark, d, "nation")
    path = new_stage_path(spark, "csv-nation")
    write_csv(nation, path)
    return read_csv(spark, path)


def q_csv_sql_view(spark, d):
    nation = read_table(spark, d, "nation")
    path = new_stage_path(spark, "csv-nation")
    write_csv(nation, path)
    csv_view(spark, "pw_nation_csv", path, schema_ddl="n_nationkey INT, n_name STRING, n_regionkey INT")
    return spark.sql("SELECT * FROM pw_nation_csv")


def q_parquet_roundtrip(spark, d):
    return stage(read_table(spark, d, "supplier"), "parquet-supplier")


def q_view_query(spark, d):
    read_table(spark, d, "part").createOrReplaceTempView("pw_part")
    return spark.sql("SELECT p_brand, count(*) AS n FROM pw_part GROUP BY p_brand")


# -- parts, IDs and keys over the overlapping-parts fixture -------------------

def q_part_counts(spark, d):
    return part_counts(fixture(spark, d).demo_src)


def q_part_offsets(spark, d):
    return part_offsets(fixture(spark, d).demo_src)


def q_rebase_patid(spark, d):
    return pipeline(spark, d).rebased("demographic")


def q_rebase_encounterid(spark, d):
    return pipeline(spark, d).rebased("encounter").select("part", "OrigEncounterID", "o_orderkey", "EncounterID")


def q_rebase_patid_window(spark, d):
    return rebase_ids(fixture(spark, d).demo_src, "PatID", method="window")


def q_key_map_provider(spark, d):
    return key_map(pipeline(spark, d).rebased("provider"), "ProviderID")


def q_rewrite_fk_enrollment(spark, d):
    return pipeline(spark, d).rewritten("enrollment").select("PatID", "part", "MedCov", "DrugCov")


def q_rewrite_fk_encounter(spark, d):
    return pipeline(spark, d).rewritten("encounter").select("FacilityID", "PatID", "o_orderkey", "EncounterID")


def q_rewrite_fk_diagnosis(spark, d):
    return pipeline(spark, d).output("diagnosis")


def q_bind_parts(spark, d):
    return bind(fixture(spark, d).enroll_src)


def q_check_ids(spark, d):
    return check_ids(pipeline(spark, d).rebased("demographic"), "PatID")


def q_coverage_after_rebase(spark, d):
    """Coverage over the *bound* tables, joined on the new PatID alone: equal
    to the per-part join of the raw keys only if the rebase is right."""
    p = pipeline(spark, d)
    return coverage_count(
        p.output("demographic"),
        p.output("enrollment"),
        on="PatID",
        by=["Sex", "Hispanic", "Race"],
        flags={"MedCov": "Y", "DrugCov": "Y"},
    )


def q_orphans_encounter(spark, d):
    fx = fixture(spark, d)
    km = fx.demo_src.select("part", F.col("PatID").alias("OrigPatID"))
    return orphans(fx.enc_src, km, "PatID").select("part", "EncounterID", "PatID")


def q_duplicate_owner_keys(spark, d):
    """Keys that collide when parts are appended without a rebase."""
    demo = fixture(spark, d).demo_src
    return fan_out(demo.withColumn("_all", F.lit(1)), "PatID", part="_all").select(
        "PatID", F.col("n").alias("n_parts")
    )


def q_dx_code_year_after_rebase(spark, d):
    dx = pipeline(spark, d).output("diagnosis")
    return code_year_rollup(dx, "DX", "DX_codetype", "ADate")


def q_bound_row_counts(spark, d):
    p = pipeline(spark, d)
    frames = [
        p.output(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in ("demographic", "facility", "provider", "encounter", "diagnosis", "enrollment")
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_rewrite_fk_procedure(spark, d):
    return pipeline(spark, d).output("procedure")


def q_rewrite_fk_dispensing(spark, d):
    return pipeline(spark, d).output("dispensing")


def q_rewrite_fk_death(spark, d):
    return pipeline(spark, d).output("death")


def q_bound_row_counts_all(spark, d):
    """Rows of all nine bound tables: every one of the twelve key rewrites."""
    p = pipeline(spark, d)
    frames = [
        p.output(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in p.reg.tables
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_code_year_rollup_csv(spark, d):
    """The rollup written over a CSV scan with inferred types, in SQL."""
    path = new_stage_path(spark, "csv-lineitem")
    write_csv(read_table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate"), path)
    csv_view(spark, "pw_lineitem_csv", path)
    return spark.sql(
        "SELECT l_returnflag AS DX, l_linestatus AS DX_codetype, CAST(year(l_shipdate) AS BIGINT) AS year, "
        "count(*) AS count FROM pw_lineitem_csv GROUP BY l_returnflag, l_linestatus, year(l_shipdate)"
    )


def q_describe_demographic_output(spark, d):
    return describe_columns(pipeline(spark, d).output("demographic"))


def q_describe_enrollment_output(spark, d):
    return describe_columns(pipeline(spark, d).output("enrollment"))


def q_land_parts(spark, d):
    """Land enrollment parts whose IDs arrive as floats, partitioned as
    ``part=NN/``; the landing casts every ``*id`` column back to bigint."""
    raw = fixture(spark, d).enroll_src.withColumn("PatID", F.col("PatID").cast("double"))
    path = new_stage_path(spark, "landing-enrollment")
    write_parts(raw, path)
    return land(read_parts(spark, path)).select("part", "PatID", "MedCov", "DrugCov")


def q_land_parts_stream(spark, d):
    """The same landing as a Structured Streaming query: part folders picked
    up by the file source, IDs cast, appended exactly-once to a partitioned
    table; run to completion (availableNow), then read back."""
    raw = fixture(spark, d).enroll_src.withColumn("PatID", F.col("PatID").cast("double"))
    src = new_stage_path(spark, "stream-src-enrollment")
    out = new_stage_path(spark, "stream-out-enrollment")
    write_parts(raw, src)
    schema = T.StructType([f for f in raw.schema.fields if f.name != "part"])
    q = land_stream(spark, src, out, schema, layout="partitioned")
    q.awaitTermination()
    return read_parts(spark, out).select("part", "PatID", "MedCov", "DrugCov")


def q_scan_table_sql(spark, d):
    return spark.sql(f"SELECT * FROM parquet.`{d.rstrip('/')}/region.parquet`")


def q_ctas_view(spark, d):
    """CREATE [OR REPLACE] ... AS SELECT and DROP ... IF EXISTS, as views:
    nothing is copied, the view is a named plan."""
    spark.sql("DROP VIEW IF EXISTS pw_ctas_nation")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW pw_ctas_nation AS SELECT * FROM parquet.`{d.rstrip('/')}/nation.parquet`")
    return spark.sql("SELECT * FROM pw_ctas_nation")


def q_code_year_rollup_sorted_nulls_first(spark, d):
    ev = read_table(spark, d, "events")
    return code_year_rollup(ev, "event_type", None, "ts", year_name="Year", count_name="n", code_alias="PX", sort="nulls_first")


def q_profile_new_patid(spark, d):
    """The profile printed after every ID assignment: of the new ID."""
    return profile_column(pipeline(spark, d).rebased("demographic"), "PatID")


def q_profile_new_patid_by_part(spark, d):
    """The new ID's profile per part, as printed after each part is assigned."""
    return profile_column(pipeline(spark, d).rebased("demographic"), "PatID", by=["part"])


def q_px_code_year_after_rebase(spark, d):
    """Procedures per (PX, PX_codetype, year), ascending by year with NULLs
    last, over the bound procedure table."""
    px = pipeline(spark, d).output("procedure")
    return code_year_rollup(px, "PX", "PX_codetype", "ADate", year_name="Year", count_name="n", sort="nulls_last")


def q_rewrite_audit(spark, d):
    """Rows in and rows dropped for each of the twelve key rewrites."""
    return pipeline(spark, d).audit()


def q_part_inventory(spark, d):
    """Rows per part of every table (0 where a part is missing)."""
    return part_inventory(fixture(spark, d).tables())


def q_coverage_patients(spark, d):
    p = pipeline(spark, d)
    return coverage_count(
        p.output("demographic"),
        p.output("enrollment"),
        on="PatID",
        by=["Sex", "Hispanic", "Race"],
        flags={"MedCov": "Y", "DrugCov": "Y"},
        distinct_people="PatID",
    )


def q_describe_diagnosis_output(spark, d):
    return describe_columns(pipeline(spark, d).output("diagnosis"))


def q_row_count_diagnosis_output(spark, d):
    return row_count(pipeline(spark, d).output("diagnosis"), formatted=True)


def q_orphans_diagnosis_encounter(spark, d):
    """Diagnosis rows lost at the EncounterID rewrite: their encounter was
    itself dropped by the PatID / FacilityID rewrites (the cascade)."""
    return pipeline(spark, d).orphans("diagnosis", "EncounterID").select("part", "EncounterID", "PatID", "ProviderID")


def q_check_ids_encounter_output(spark, d):
    """New EncounterIDs after the cascade: unique, but with gaps."""
    return check_ids(pipeline(spark, d).output("encounter"), "EncounterID")


def q_bind_parts_union(spark, d):
    """Bind by UNION ALL of one scan per part: each scan reads only its own
    part=NN directory (partition pruning), and the schemas are checked
    before the positional union."""
    path = new_stage_path(spark, "landing-enrollment")
    write_parts(fixture(spark, d).enroll_src, path)
    landed = read_parts(spark, path)
    numbers = [int(f.rsplit("=", 1)[1]) for f in part_folders(spark, [path])]
    frames = [landed.where(F.col("part") == i).drop("part").select("PatID", "MedCov", "DrugCov") for i in numbers]
    return union_parts(frames)


def _numbered_files(df: DataFrame, folder: str, table: str, fmt: str) -> None:
    """Writes ``df`` (with ``part``) as one file a part, named like an extract, in one job: rows are dealt
    out by part and each task writes its parts' folders, whose files are then renamed. Odd CSV parts have
    their columns the other way round (a job each way)."""
    spark = df.sparkSession
    fs_ = spark._jvm.org.apache.hadoop.fs
    to = fs_.Path(folder)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to)
    names = [c for c in df.columns if c != "part"]
    ways = {"made": names} if fmt != "csv" else {"made-odd": names[::-1], "made-even": names}
    for made, order in ways.items():
        some = df if fmt != "csv" else df.where(F.col("part") % 2 == int(made == "made-odd"))
        writer = some.select(*order, "part").repartition("part").write.partitionBy("part")
        with unsorted_folders(spark):  # a task may have several parts
            (writer.option("header", "true").option("escape", '"').csv if fmt == "csv" else writer.parquet)(f"{folder}-{made}")
        for file in fs.globStatus(fs_.Path(f"{folder}-{made}/part=*/part-*")):
            i = file.getPath().getParent().getName().removeprefix("part=")
            name = f"{table}_{i}.csv" if fmt == "csv" else f"{table}-{i}-snappy.parquet"
            fs.rename(file.getPath(), fs_.Path(f"{folder}/{name}"))


def q_csv_parts_lossless(spark, d):
    """Numbered CSV extracts of every line item: columns in another order in odd
    parts, codes with leading zeros, quotes and commas inside fields, and a file of
    another table whose name begins alike."""
    path = new_stage_path(spark, "csv-parts")
    li = read_table(spark, d, "lineitem")
    code = F.lpad(F.col("l_partkey").cast("string"), 11, "0").alias("NDC")
    note = F.concat(F.lit('say "'), F.col("l_returnflag"), F.lit('", twice, "" end')).alias("Note")
    out = li.select(F.col("l_linenumber").cast("long").alias("part"), F.col("l_orderkey").alias("EncounterID"), F.col("l_suppkey").alias("PatID"), code, note)
    _numbered_files(out, path, "dispensing", "csv")
    decoy = read_table(spark, d, "region").select(F.lit(1).cast("long").alias("part"), F.col("r_regionkey").alias("EncounterID"))
    _numbered_files(decoy, f"{path}-decoy", "dispensing_codes", "csv")
    fs = spark._jvm.org.apache.hadoop.fs
    to = fs.Path(f"{path}/dispensing_codes_1.csv")
    to.getFileSystem(spark._jsc.hadoopConfiguration()).rename(fs.Path(f"{path}-decoy/dispensing_codes_1.csv"), to)
    return land(read_csv_parts(spark, path, "dispensing")).select("part", "EncounterID", "PatID", "NDC", "Note")


def q_flat_parquet_parts(spark, d):
    """Numbered Parquet parts in one folder, the part taken from each file's name."""
    path = new_stage_path(spark, "flat-parts")
    o = read_table(spark, d, "orders")
    part = (F.col("o_orderkey") % 5 + 1).cast("long").alias("part")
    _numbered_files(o.select(part, "o_orderkey", "o_custkey", "o_orderdate"), path, "encounter", "parquet")
    return read_parts(spark, path, layout="flat").select("part", "o_orderkey", "o_custkey", "o_orderdate")


def q_mixed_case_key(spark, d):
    """A foreign key spelled in another case than its owner's is rewritten all the same."""
    fx = fixture(spark, d)
    tables = {"demographic": fx.demo_src, "enrollment": fx.enroll_src.withColumnRenamed("PatID", "patid")}
    reg = Registry(("demographic", "enrollment"), {"demographic": "PatID"}, (ForeignKey("enrollment", "patid", "demographic"),))
    return Pipeline(tables, reg).output("enrollment").select(F.col("PatID").alias("PatID"), "MedCov", "DrugCov")


_INTEGRATED: dict[tuple[str, str], dict[str, str]] = {}


def _integrated(spark: SparkSession, d: str) -> dict[str, str]:
    """All nine tables landed as ``part=NN/`` folders, integrated and written, once an application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _INTEGRATED:
        landing, out = new_stage_path(spark, "landing"), new_stage_path(spark, "output")
        for t, df in fixture(spark, d).tables().items():
            write_parts(land(df), f"{landing}/{t}")
        _INTEGRATED[key] = integrate(spark, landing, out)
    return _INTEGRATED[key]


def _q_integrated(table: str) -> Query:
    def query(spark, d):
        return spark.read.parquet(_integrated(spark, d)[table])

    return query


def q_integrated_columns(spark, d):
    """Every column of the nine written tables in its place - keys of later rewrites first, new owner IDs
    last - and how many of its values are set."""
    frames = []
    for table, path in sorted(_integrated(spark, d).items()):
        df = spark.read.parquet(path)
        one = [
            F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("column_name"), F.count(c).alias("n_set"))
            for i, c in enumerate(df.columns, 1)
        ]
        frames.append(df.agg(F.array(*one).alias("a")).select(F.lit(table).alias("table_name"), F.inline("a")))
    return reduce(DataFrame.unionAll, frames)


QUERIES: dict[str, Query] = {
    "integrated_columns": q_integrated_columns,
    "csv_parts_lossless": q_csv_parts_lossless,
    "flat_parquet_parts": q_flat_parquet_parts,
    "mixed_case_key": q_mixed_case_key,
    **{f"integrated_{t}": _q_integrated(t) for t in CLAIMS.tables},
    "scan_table": q_scan_table,
    "row_count": q_row_count,
    "row_count_formatted": q_row_count_formatted,
    "describe_columns": q_describe_columns,
    "code_year_rollup": q_code_year_rollup,
    "code_year_rollup_sql": q_code_year_rollup_sql,
    "code_year_rollup_sorted": q_code_year_rollup_sorted,
    "coverage_count": q_coverage_count,
    "profile_column": q_profile_column,
    "cast_ids_by_suffix": q_cast_ids_by_suffix,
    "rename_drop": q_rename_drop,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_inferred_roundtrip": q_csv_inferred_roundtrip,
    "csv_sql_view": q_csv_sql_view,
    "parquet_roundtrip": q_parquet_roundtrip,
    "view_query": q_view_query,
    "part_counts": q_part_counts,
    "part_offsets": q_part_offsets,
    "rebase_patid": q_rebase_patid,
    "rebase_patid_window": q_rebase_patid_window,
    "rebase_encounterid": q_rebase_encounterid,
    "key_map_provider": q_key_map_provider,
    "rewrite_fk_enrollment": q_rewrite_fk_enrollment,
    "rewrite_fk_encounter": q_rewrite_fk_encounter,
    "rewrite_fk_diagnosis": q_rewrite_fk_diagnosis,
    "bind_parts": q_bind_parts,
    "check_ids": q_check_ids,
    "coverage_after_rebase": q_coverage_after_rebase,
    "orphans_encounter": q_orphans_encounter,
    "duplicate_owner_keys": q_duplicate_owner_keys,
    "dx_code_year_after_rebase": q_dx_code_year_after_rebase,
    "bound_row_counts": q_bound_row_counts,
    "land_parts": q_land_parts,
    "scan_table_sql": q_scan_table_sql,
    "ctas_view": q_ctas_view,
    "code_year_rollup_sorted_nulls_first": q_code_year_rollup_sorted_nulls_first,
    "profile_new_patid": q_profile_new_patid,
    "coverage_patients": q_coverage_patients,
    "describe_diagnosis_output": q_describe_diagnosis_output,
    "row_count_diagnosis_output": q_row_count_diagnosis_output,
    "orphans_diagnosis_encounter": q_orphans_diagnosis_encounter,
    "check_ids_encounter_output": q_check_ids_encounter_output,
    "bind_parts_union": q_bind_parts_union,
    "rewrite_fk_procedure": q_rewrite_fk_procedure,
    "rewrite_fk_dispensing": q_rewrite_fk_dispensing,
    "rewrite_fk_death": q_rewrite_fk_death,
    "bound_row_counts_all": q_bound_row_counts_all,
    "code_year_rollup_csv": q_code_year_rollup_csv,
    "describe_demographic_output": q_describe_demographic_output,
    "describe_enrollment_output": q_describe_enrollment_output,
    "profile_new_patid_by_part": q_profile_new_patid_by_part,
    "part_inventory": q_part_inventory,
    "px_code_year_after_rebase": q_px_code_year_after_rebase,
    "rewrite_audit": q_rewrite_audit,
    "land_parts_stream": q_land_parts_stream,
}


# -- DuckDB oracles -----------------------------------------------------------

# The overlapping-parts fixture as SQL CTEs (same frames as fixtures.py).
FIXTURE_CTES = """
demo_raw AS (
  SELECT CAST(n_regionkey + 1 AS BIGINT) AS part,
         row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey) AS PatID,
         c_custkey, c_mktsegment AS Sex, CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS Hispanic, c_nationkey AS Race
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
demo_src AS (SELECT * FROM demo_raw WHERE c_custkey % 10 <> 0),
fac_src AS (
  SELECT part, ord + part AS FacilityID
  FROM range(1, 6) r(part), range(1, 6) o(ord)
  WHERE NOT (part % 2 = 1 AND ord = 5)),
prov_src AS (
  SELECT part, s_suppkey + part AS ProviderID, s_name
  FROM supplier, range(1, 6) r(part)
  WHERE NOT (part % 2 = 0 AND s_suppkey % 20 = 0)),
enc_src AS (
  SELECT d.part,
         row_number() OVER (PARTITION BY d.part ORDER BY o_orderkey) AS EncounterID,
         d.PatID,
         CASE WHEN o_orderstatus = 'P' AND o_custkey % 5 = 1 THEN NULL
              ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + d.part END AS FacilityID,
         o_orderkey, o_orderdate AS ADate
  FROM orders JOIN demo_raw d ON o_custkey = d.c_custkey),
dx_src AS (
  SELECT e.part, e.EncounterID, e.PatID, l_suppkey + e.part AS ProviderID,
         l_returnflag AS DX, l_linestatus AS DX_codetype, l_shipdate AS ADate
  FROM lineitem JOIN enc_src e ON l_orderkey = e.o_orderkey),
enroll_src AS (
  SELECT d.part, d.PatID,
         CASE WHEN o_orderstatus <> 'P' THEN 'Y' ELSE 'N' END AS MedCov,
         CASE WHEN o_orderpriority < '4' THEN 'Y' ELSE 'N' END AS DrugCov
  FROM orders JOIN demo_raw d ON o_custkey = d.c_custkey),
death_src AS (
  SELECT d.part, d.PatID, d.Sex AS Source
  FROM demo_raw d),
disp_src AS (
  SELECT e.part, e.PatID, l_suppkey + e.part AS ProviderID, CAST(l_partkey AS VARCHAR) AS NDC, l_shipdate AS RxDate
  FROM lineitem JOIN enc_src e ON l_orderkey = e.o_orderkey),
proc_src AS (
  SELECT e.part, e.EncounterID, e.PatID, l_suppkey + e.part AS ProviderID,
         CAST(l_linenumber AS VARCHAR) AS PX, l_linestatus AS PX_codetype, l_shipdate AS ADate
  FROM lineitem JOIN enc_src e ON l_orderkey = e.o_orderkey)"""

# Rebased owners and the cascade, shared by several oracles.
_D = "d AS (SELECT part, PatID AS OrigPatID, row_number() OVER (ORDER BY part, PatID) AS PatID FROM demo_src)"
_F = "f AS (SELECT part, FacilityID AS OrigFacilityID, row_number() OVER (ORDER BY part, FacilityID) AS FacilityID FROM fac_src)"
_P = "p AS (SELECT part, ProviderID AS OrigProviderID, row_number() OVER (ORDER BY part, ProviderID) AS ProviderID FROM prov_src)"
_E = "e AS (SELECT *, row_number() OVER (ORDER BY part, EncounterID) AS NewEncounterID FROM enc_src)"
_E2 = (
    "e2 AS (SELECT e.part, e.EncounterID AS OrigEncounterID, e.NewEncounterID FROM e "
    "JOIN d ON d.part = e.part AND d.OrigPatID = e.PatID JOIN f ON f.part = e.part AND f.OrigFacilityID = e.FacilityID)"
)
_DX_OUT = (
    "dx_out AS (SELECT e2.NewEncounterID AS EncounterID, p.ProviderID, d.PatID, x.DX, x.DX_codetype, x.ADate FROM dx_src x "
    "JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID JOIN p ON p.part = x.part AND p.OrigProviderID = x.ProviderID "
    "JOIN e2 ON e2.part = x.part AND e2.OrigEncounterID = x.EncounterID)"
)


def fix(*ctes: str) -> str:
    return "WITH " + ",\n".join([FIXTURE_CTES.strip(), *ctes]) + "\n"


ORACLES: dict[str, str] = {
    "scan_table": "SELECT * FROM region",
    "row_count": "SELECT count(*) AS count FROM lineitem",
    "row_count_formatted": "SELECT format('{:,}', count(*)) AS count FROM lineitem",
    "describe_columns": "SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM orders)",
    "code_year_rollup": (
        "SELECT l_returnflag AS DX, l_linestatus AS DX_codetype, year(l_shipdate) AS year, count(*) AS count "
        "FROM lineitem GROUP BY l_returnflag, l_linestatus, year(l_shipdate)"
    ),
    "code_year_rollup_sorted": (
        "SELECT year(ts) AS Year, event_type AS PX, count(*) AS n FROM events "
        "GROUP BY ALL ORDER BY Year NULLS LAST"
    ),
    "coverage_count": (
        "SELECT c_mktsegment AS Sex, c_nationkey AS Race, count(*) AS count "
        "FROM customer a JOIN orders b ON a.c_custkey = b.o_custkey "
        "WHERE b.o_orderstatus = 'F' AND b.o_orderpriority = '1-URGENT' GROUP BY c_mktsegment, c_nationkey"
    ),
    "profile_column": (
        "SELECT 'o_custkey' AS column_name, 'BIGINT' AS column_type, min(o_custkey) AS min, max(o_custkey) AS max, "
        "count(DISTINCT o_custkey) AS n_unique, round(avg(o_custkey), 6) AS avg, round(stddev_samp(o_custkey), 6) AS std, "
        "round(quantile_cont(o_custkey, 0.25), 6) AS q25, round(quantile_cont(o_custkey, 0.5), 6) AS q50, "
        "round(quantile_cont(o_custkey, 0.75), 6) AS q75, count(*) AS count, "
        "round(100.0 * (count(*) - count(o_custkey)) / count(*), 2)::DOUBLE AS null_percentage FROM orders"
    ),
    "cast_ids_by_suffix": (
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
    ),
    "rename_drop": "SELECT o_orderkey, o_custkey AS Origo_custkey, o_totalprice FROM orders",
    "csv_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "csv_inferred_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "csv_sql_view": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "parquet_roundtrip": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "view_query": "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand",
    "part_counts": fix() + "SELECT part, count(*) AS n_rows FROM demo_src GROUP BY part",
    "part_offsets": fix() + (
        "SELECT part, count(*) AS n_rows, "
        "CAST(1 + coalesce(sum(count(*)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_id "
        "FROM demo_src GROUP BY part"
    ),
    "rebase_patid": fix() + (
        "SELECT part, PatID AS OrigPatID, c_custkey, Sex, Hispanic, Race, row_number() OVER (ORDER BY part, PatID) AS PatID FROM demo_src"
    ),
    "rebase_patid_window": fix() + (
        "SELECT part, PatID AS OrigPatID, c_custkey, Sex, Hispanic, Race, row_number() OVER (ORDER BY part, PatID) AS PatID FROM demo_src"
    ),
    "rebase_encounterid": fix() + (
        "SELECT part, EncounterID AS OrigEncounterID, o_orderkey, row_number() OVER (ORDER BY part, EncounterID) AS EncounterID FROM enc_src"
    ),
    "key_map_provider": fix() + (
        "SELECT part, ProviderID AS OrigProviderID, row_number() OVER (ORDER BY part, ProviderID) AS ProviderID FROM prov_src"
    ),
    "rewrite_fk_enrollment": fix(_D) + (
        "SELECT d.PatID, b.part, b.MedCov, b.DrugCov FROM d JOIN enroll_src b ON d.part = b.part AND d.OrigPatID = b.PatID"
    ),
    "rewrite_fk_encounter": fix(_D, _F, _E) + (
        "SELECT f.FacilityID, d.PatID, e.o_orderkey, e.NewEncounterID AS EncounterID "
        "FROM e JOIN d ON d.part = e.part AND d.OrigPatID = e.PatID JOIN f ON f.part = e.part AND f.OrigFacilityID = e.FacilityID"
    ),
    "rewrite_fk_diagnosis": fix(_D, _F, _P, _E, _E2, _DX_OUT) + "SELECT * FROM dx_out",
    "bind_parts": fix() + (
        "SELECT PatID, MedCov, DrugCov FROM enroll_src WHERE part = 1 UNION ALL SELECT PatID, MedCov, DrugCov FROM enroll_src WHERE part = 2 "
        "UNION ALL SELECT PatID, MedCov, DrugCov FROM enroll_src WHERE part = 3 UNION ALL SELECT PatID, MedCov, DrugCov FROM enroll_src WHERE part = 4 "
        "UNION ALL SELECT PatID, MedCov, DrugCov FROM enroll_src WHERE part = 5"
    ),
    "check_ids": fix("d AS (SELECT row_number() OVER (ORDER BY part, PatID) AS PatID FROM demo_src)") + (
        "SELECT count(*) AS n_rows, count(DISTINCT PatID) AS n_distinct, min(PatID) AS min_id, max(PatID) AS max_id, "
        "count(*) - count(PatID) AS n_null, (count(*) = count(DISTINCT PatID) AND min(PatID) = 1 AND max(PatID) = count(*)) AS is_dense FROM d"
    ),
    "coverage_after_rebase": fix() + (
        "SELECT d.Sex, d.Hispanic, d.Race, count(*) AS count FROM demo_src d JOIN enroll_src b ON d.part = b.part AND d.PatID = b.PatID "
        "WHERE b.MedCov = 'Y' AND b.DrugCov = 'Y' GROUP BY d.Sex, d.Hispanic, d.Race"
    ),
    "orphans_encounter": fix() + (
        "SELECT e.part, e.EncounterID, e.PatID FROM enc_src e ANTI JOIN demo_src d ON d.part = e.part AND d.PatID = e.PatID"
    ),
    "duplicate_owner_keys": fix() + "SELECT PatID, count(*) AS n_parts FROM demo_src GROUP BY PatID HAVING count(*) > 1",
    "dx_code_year_after_rebase": fix(_D, _F, _P, _E, _E2, _DX_OUT) + (
        "SELECT DX, DX_codetype, year(ADate) AS year, count(*) AS count FROM dx_out GROUP BY DX, DX_codetype, year(ADate)"
    ),
    "bound_row_counts": fix(_D, _F, _P, _E, _E2, _DX_OUT) + (
        "SELECT 'demographic' AS table_name, count(*) AS n_rows FROM demo_src "
        "UNION ALL SELECT 'facility', count(*) FROM fac_src "
        "UNION ALL SELECT 'provider', count(*) FROM prov_src "
        "UNION ALL SELECT 'encounter', count(*) FROM e2 "
        "UNION ALL SELECT 'diagnosis', count(*) FROM dx_out "
        "UNION ALL SELECT 'enrollment', count(*) FROM d JOIN enroll_src b ON d.part = b.part AND d.OrigPatID = b.PatID"
    ),
    "land_parts": fix() + "SELECT part, PatID, MedCov, DrugCov FROM enroll_src",
}
ORACLES["code_year_rollup_sql"] = ORACLES["code_year_rollup"]
ORACLES["code_year_rollup_csv"] = ORACLES["code_year_rollup"]
ORACLES["land_parts_stream"] = ORACLES["land_parts"]
ORACLES.update(
    {
        "scan_table_sql": "SELECT * FROM region",
        "ctas_view": "SELECT * FROM nation",
        "code_year_rollup_sorted_nulls_first": (
            "SELECT year(ts) AS Year, event_type AS PX, count(*) AS n FROM events "
            "GROUP BY ALL ORDER BY Year NULLS FIRST"
        ),
        "profile_new_patid": fix("d AS (SELECT row_number() OVER (ORDER BY part, PatID) AS PatID FROM demo_src)") + (
            "SELECT 'PatID' AS column_name, 'BIGINT' AS column_type, min(PatID) AS min, max(PatID) AS max, "
            "count(DISTINCT PatID) AS n_unique, round(avg(PatID), 6) AS avg, round(stddev_samp(PatID), 6) AS std, "
            "round(quantile_cont(PatID, 0.25), 6) AS q25, round(quantile_cont(PatID, 0.5), 6) AS q50, "
            "round(quantile_cont(PatID, 0.75), 6) AS q75, count(*) AS count, "
            "round(100.0 * (count(*) - count(PatID)) / count(*), 2)::DOUBLE AS null_percentage FROM d"
        ),
        "profile_new_patid_by_part": fix("d AS (SELECT part, row_number() OVER (ORDER BY part, PatID) AS PatID FROM demo_src)") + (
            "SELECT part, 'PatID' AS column_name, 'BIGINT' AS column_type, min(PatID) AS min, max(PatID) AS max, "
            "count(DISTINCT PatID) AS n_unique, round(avg(PatID), 6) AS avg, round(stddev_samp(PatID), 6) AS std, "
            "round(quantile_cont(PatID, 0.25), 6) AS q25, round(quantile_cont(PatID, 0.5), 6) AS q50, "
            "round(quantile_cont(PatID, 0.75), 6) AS q75, count(*) AS count, "
            "round(100.0 * (count(*) - count(PatID)) / count(*), 2)::DOUBLE AS null_percentage FROM d GROUP BY part"
        ),
        "px_code_year_after_rebase": fix(_D, _F, _P, _E, _E2) + (
            "SELECT x.PX, x.PX_codetype, year(x.ADate) AS Year, count(*) AS n FROM proc_src x "
            "JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID JOIN p ON p.part = x.part AND p.OrigProviderID = x.ProviderID "
            "JOIN e2 ON e2.part = x.part AND e2.OrigEncounterID = x.EncounterID "
            "GROUP BY x.PX, x.PX_codetype, year(x.ADate) ORDER BY Year NULLS LAST"
        ),
        "rewrite_audit": fix(_D, _F, _P, _E, _E2) + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{k}' AS id_col, (SELECT count(*) FROM {src}) AS rows_in, "
            f"(SELECT count(*) FROM {src} x ANTI JOIN {own} o ON o.part = x.part AND o.{orig} = x.{k}) AS orphans"
            for t, k, src, own, orig in (
                ("death", "PatID", "death_src", "d", "OrigPatID"),
                ("diagnosis", "PatID", "dx_src", "d", "OrigPatID"),
                ("dispensing", "PatID", "disp_src", "d", "OrigPatID"),
                ("encounter", "PatID", "enc_src", "d", "OrigPatID"),
                ("enrollment", "PatID", "enroll_src", "d", "OrigPatID"),
                ("procedure", "PatID", "proc_src", "d", "OrigPatID"),
                ("diagnosis", "ProviderID", "dx_src", "p", "OrigProviderID"),
                ("dispensing", "ProviderID", "disp_src", "p", "OrigProviderID"),
                ("procedure", "ProviderID", "proc_src", "p", "OrigProviderID"),
                ("encounter", "FacilityID", "enc_src", "f", "OrigFacilityID"),
                ("diagnosis", "EncounterID", "dx_src", "e2", "OrigEncounterID"),
                ("procedure", "EncounterID", "proc_src", "e2", "OrigEncounterID"),
            )
        ),
        "part_inventory": fix() + (
            "SELECT part, "
            + ", ".join(
                f"CAST(count(*) FILTER (WHERE t = '{t}') AS BIGINT) AS {t}"
                for t in ("death", "demographic", "diagnosis", "dispensing", "encounter", "enrollment", "procedure", "facility", "provider")
            )
            + " FROM ("
            + " UNION ALL ".join(
                f"SELECT part, '{t}' AS t FROM {src}"
                for t, src in (
                    ("death", "death_src"), ("demographic", "demo_src"), ("diagnosis", "dx_src"), ("dispensing", "disp_src"),
                    ("encounter", "enc_src"), ("enrollment", "enroll_src"), ("procedure", "proc_src"),
                    ("facility", "fac_src"), ("provider", "prov_src"),
                )
            )
            + ") GROUP BY part"
        ),
        "coverage_patients": fix(_D) + (
            "SELECT s.Sex, s.Hispanic, s.Race, count(*) AS count, count(DISTINCT d.PatID) AS n_people FROM d "
            "JOIN demo_src s ON s.part = d.part AND s.PatID = d.OrigPatID "
            "JOIN enroll_src b ON d.part = b.part AND d.OrigPatID = b.PatID "
            "WHERE b.MedCov = 'Y' AND b.DrugCov = 'Y' GROUP BY s.Sex, s.Hispanic, s.Race"
        ),
        "describe_diagnosis_output": (
            "SELECT column_name, column_type FROM (DESCRIBE ("
            + fix(_D, _F, _P, _E, _E2, _DX_OUT)
            + "SELECT * FROM dx_out))"
        ),
        "row_count_diagnosis_output": fix(_D, _F, _P, _E, _E2, _DX_OUT) + "SELECT format('{:,}', count(*)) AS count FROM dx_out",
        "orphans_diagnosis_encounter": fix(_D, _F, _E, _E2) + (
            "SELECT x.part, x.EncounterID, x.PatID, x.ProviderID FROM dx_src x "
            "ANTI JOIN e2 ON e2.part = x.part AND e2.OrigEncounterID = x.EncounterID"
        ),
        "check_ids_encounter_output": fix(_D, _F, _E, _E2) + (
            "SELECT count(*) AS n_rows, count(DISTINCT NewEncounterID) AS n_distinct, min(NewEncounterID) AS min_id, "
            "max(NewEncounterID) AS max_id, count(*) - count(NewEncounterID) AS n_null, "
            "(count(*) = count(DISTINCT NewEncounterID) AND min(NewEncounterID) = 1 AND max(NewEncounterID) = count(*)) AS is_dense FROM e2"
        ),
        "bind_parts_union": fix() + "SELECT PatID, MedCov, DrugCov FROM enroll_src",
        "describe_demographic_output": (
            "SELECT column_name, column_type FROM (DESCRIBE ("
            + fix(_D)
            + "SELECT s.c_custkey, s.Sex, s.Hispanic, s.Race, d.PatID FROM demo_src s JOIN d ON d.part = s.part AND d.OrigPatID = s.PatID))"
        ),
        "describe_enrollment_output": (
            "SELECT column_name, column_type FROM (DESCRIBE ("
            + fix(_D)
            + "SELECT d.PatID, b.MedCov, b.DrugCov FROM d JOIN enroll_src b ON d.part = b.part AND d.OrigPatID = b.PatID))"
        ),
        "rewrite_fk_procedure": fix(_D, _F, _P, _E, _E2) + (
            "SELECT e2.NewEncounterID AS EncounterID, p.ProviderID, d.PatID, x.PX, x.PX_codetype, x.ADate FROM proc_src x "
            "JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID JOIN p ON p.part = x.part AND p.OrigProviderID = x.ProviderID "
            "JOIN e2 ON e2.part = x.part AND e2.OrigEncounterID = x.EncounterID"
        ),
        "rewrite_fk_dispensing": fix(_D, _P) + (
            "SELECT p.ProviderID, d.PatID, x.NDC, x.RxDate FROM disp_src x "
            "JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID JOIN p ON p.part = x.part AND p.OrigProviderID = x.ProviderID"
        ),
        "rewrite_fk_death": fix(_D) + (
            "SELECT d.PatID, x.Source FROM death_src x JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID"
        ),
        "bound_row_counts_all": fix(_D, _F, _P, _E, _E2, _DX_OUT) + (
            "SELECT 'death' AS table_name, count(*) AS n_rows FROM death_src x JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID "
            "UNION ALL SELECT 'demographic', count(*) FROM demo_src "
            "UNION ALL SELECT 'diagnosis', count(*) FROM dx_out "
            "UNION ALL SELECT 'dispensing', count(*) FROM disp_src x JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID "
            "JOIN p ON p.part = x.part AND p.OrigProviderID = x.ProviderID "
            "UNION ALL SELECT 'encounter', count(*) FROM e2 "
            "UNION ALL SELECT 'enrollment', count(*) FROM d JOIN enroll_src b ON d.part = b.part AND d.OrigPatID = b.PatID "
            "UNION ALL SELECT 'procedure', count(*) FROM proc_src x JOIN d ON d.part = x.part AND d.OrigPatID = x.PatID "
            "JOIN p ON p.part = x.part AND p.OrigProviderID = x.ProviderID JOIN e2 ON e2.part = x.part AND e2.OrigEncounterID = x.EncounterID "
            "UNION ALL SELECT 'facility', count(*) FROM fac_src "
            "UNION ALL SELECT 'provider', count(*) FROM prov_src"
        ),
    }
)

_ENROLLED = "SELECT d.PatID, b.MedCov, b.DrugCov FROM d JOIN enroll_src b ON d.part = b.part AND d.OrigPatID = b.PatID"
ORACLES.update(
    {
        "csv_parts_lossless": (
            "SELECT CAST(l_linenumber AS BIGINT) AS part, l_orderkey AS EncounterID, l_suppkey AS PatID, "
            "lpad(CAST(l_partkey AS VARCHAR), 11, '0') AS NDC, 'say \"' || l_returnflag || '\", twice, \"\" end' AS Note FROM lineitem"
        ),
        "flat_parquet_parts": "SELECT CAST(o_orderkey % 5 + 1 AS BIGINT) AS part, o_orderkey, o_custkey, o_orderdate FROM orders",
        "mixed_case_key": fix(_D) + _ENROLLED,
        "integrated_demographic": fix(_D) + (
            "SELECT s.c_custkey, s.Sex, s.Hispanic, s.Race, d.PatID FROM demo_src s JOIN d ON d.part = s.part AND d.OrigPatID = s.PatID"
        ),
        "integrated_facility": fix(_F) + "SELECT FacilityID FROM f",
        "integrated_provider": fix(_P) + (
            "SELECT s.s_name, p.ProviderID FROM prov_src s JOIN p ON p.part = s.part AND p.OrigProviderID = s.ProviderID"
        ),
        "integrated_encounter": fix(_D, _F, _E) + (
            "SELECT f.FacilityID, d.PatID, e.o_orderkey, e.ADate, e.NewEncounterID AS EncounterID FROM e "
            "JOIN d ON d.part = e.part AND d.OrigPatID = e.PatID JOIN f ON f.part = e.part AND f.OrigFacilityID = e.FacilityID"
        ),
        "integrated_enrollment": fix(_D) + _ENROLLED,
        "integrated_diagnosis": fix(_D, _F, _P, _E, _E2, _DX_OUT) + "SELECT * FROM dx_out",
        **{f"integrated_{t}": ORACLES[f"rewrite_fk_{t}"] for t in ("procedure", "dispensing", "death")},
    }
)

# The columns of each output in the order in which renames, joins and drops leave them.
_OUTPUT_COLUMNS = {
    "death": "PatID Source",
    "demographic": "c_custkey Sex Hispanic Race PatID",
    "diagnosis": "EncounterID ProviderID PatID DX DX_codetype ADate",
    "dispensing": "ProviderID PatID NDC RxDate",
    "encounter": "FacilityID PatID o_orderkey ADate EncounterID",
    "enrollment": "PatID MedCov DrugCov",
    "facility": "FacilityID",
    "procedure": "EncounterID ProviderID PatID PX PX_codetype ADate",
    "provider": "s_name ProviderID",
}
ORACLES["integrated_columns"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({i} AS BIGINT) AS position, '{c}' AS column_name, count({c}) AS n_set FROM ({ORACLES[f'integrated_{t}']})"
    for t, columns in _OUTPUT_COLUMNS.items()
    for i, c in enumerate(columns.split(), 1)
)
ORACLES["part_footers"] = fix() + "SELECT part, CAST(count(*) AS BIGINT) AS n_rows, true AS one_kind FROM enroll_src GROUP BY part"
QUERIES.update(STATE_QUERIES)
ORACLES.update(STATE_ORACLES | {name: ORACLES[other] for name, other in SAME_AS.items()})

assert set(ORACLES) == set(QUERIES), set(QUERIES) ^ set(ORACLES)
