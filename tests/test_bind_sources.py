import os

import pytest
from pyspark.sql import functions as F

from partweave.operators.bind import SchemaMismatch, bind, union_parts
from partweave.session import new_stage_path
from partweave.sources.csv import csv_view, read_csv, write_csv
from partweave.sources.parts import check_part_schemas, land, read_parts, write_parts


def test_union_refuses_positional_mismatch(spark):
    a = spark.createDataFrame([(1, "x")], "PatID long, s string")
    b = spark.createDataFrame([("y", 2)], "s string, PatID long")
    with pytest.raises(SchemaMismatch):
        union_parts([a, b])
    c = spark.createDataFrame([(3, "z")], "patid long, s string")
    assert union_parts([a, c]).count() == 2


def test_bind_drops_part_and_orders(spark):
    df = spark.createDataFrame([(1, 5, "a")], "part long, PatID long, s string")
    assert bind(df).columns == ["PatID", "s"]
    assert bind(df, columns=["s", "PatID"]).columns == ["s", "PatID"]


def test_flat_part_names_12_is_not_1_then_2(spark, tmp_path):
    for i in (1, 2, 12):
        spark.createDataFrame([(i * 1.0, f"r{i}")], "PatID double, s string").coalesce(1).write.parquet(
            str(tmp_path / f"stage{i}")
        )
        [f] = [x for x in os.listdir(tmp_path / f"stage{i}") if x.endswith(".parquet")]
        os.link(tmp_path / f"stage{i}" / f, tmp_path / f"t-{i}-snappy.parquet")
    paths = [str(tmp_path / f"t-{i}-snappy.parquet") for i in (1, 2, 12)]
    check_part_schemas(spark, paths)
    df = land(read_parts(spark, paths, layout="flat"))
    got = sorted((r.part, r.PatID, r.s) for r in df.collect())
    assert got == [(1, 1, "r1"), (2, 2, "r2"), (12, 12, "r12")]
    assert dict(df.dtypes)["PatID"] == "bigint"


def test_partitioned_layout_prunes(spark):
    df = spark.createDataFrame([(p, i * 1.0) for p in (1, 2, 3) for i in range(4)], "part long, EncounterID double")
    path = new_stage_path(spark, "test-parts")
    write_parts(df, path)
    landed = land(read_parts(spark, path))
    assert dict(landed.dtypes)["EncounterID"] == "bigint"
    one = landed.where(F.col("part") == 2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and one.count() == 4


def test_csv_declared_inferred_and_view(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "k int, s string, x double")
    path = new_stage_path(spark, "test-csv")
    write_csv(df, path)
    assert read_csv(spark, path, schema=df.schema).dtypes == df.dtypes
    assert dict(read_csv(spark, path).dtypes)["k"] == "int"
    v = csv_view(spark, "t_csv_view", path, schema_ddl="k INT, s STRING, x DOUBLE")
    assert sorted(tuple(r) for r in v.collect()) == [(1, "a", 2.5), (2, "b", None)]


def test_part_inventory_and_missing_parts(spark):
    from partweave.operators.parts import missing_parts, part_inventory

    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "part long, v string")
    b = spark.createDataFrame([(2, "q"), (3, "r")], "part long, v string")
    inv = {r.part: (r.a, r.b) for r in part_inventory({"a": a, "b": b}).collect()}
    assert inv == {1: (2, 0), 2: (1, 1), 3: (0, 1)}
    gaps = sorted(tuple(r) for r in missing_parts({"a": a, "b": b}).collect())
    assert gaps == [("a", 3), ("b", 1)]


def test_unsigned_ids_land_as_bigint(spark, tmp_path):
    """Unsigned 64-bit IDs read back as decimal(20,0) in Spark (H5); landing
    casts them to bigint."""
    import duckdb

    path = str(tmp_path / "u.parquet")
    duckdb.sql(f"COPY (SELECT 18::UBIGINT AS PatID, 'a' AS s UNION ALL SELECT 7::UBIGINT, 'b') TO '{path}' (FORMAT parquet)")
    raw = spark.read.parquet(path)
    assert dict(raw.dtypes)["PatID"].startswith("decimal(20")
    out = land(raw)
    assert dict(out.dtypes)["PatID"] == "bigint"
    assert sorted((r.PatID, r.s) for r in out.collect()) == [(7, "b"), (18, "a")]


def test_writes_never_overwrite(spark, tmp_path):
    """Every run writes to a new folder; an existing one is refused (H16)."""
    from partweave.operators.bind import write_table

    df = spark.range(3)
    path = str(tmp_path / "out")
    write_table(df, path)
    with pytest.raises(Exception):
        write_table(df, path)
    assert spark.read.parquet(path).count() == 3


def test_csv_parts_by_spark_reader(spark, tmp_path):
    from partweave.sources.csv import read_csv_parts

    for i, n in ((1, 2), (12, 3)):
        (tmp_path / f"death_{i}.csv").write_text("PatID,Source\n" + "".join(f"{k}.0,s{i}\n" for k in range(n)))
    (tmp_path / "deathx_1.csv").write_text("PatID,Source\n9.0,zz\n")
    df = land(read_csv_parts(spark, str(tmp_path), "death"))
    got = sorted((r.part, r.PatID, r.Source) for r in df.collect())
    assert got == [(1, 0, "s1"), (1, 1, "s1"), (12, 0, "s12"), (12, 1, "s12"), (12, 2, "s12")]
    assert dict(df.dtypes)["PatID"] == "bigint"


def test_flat_parts_with_drifting_schema_are_refused(spark, tmp_path):
    import os

    for i, ddl, row in ((1, "PatID double, s string", (1.0, "a")), (2, "s string, PatID double", ("b", 2.0))):
        stage_dir = tmp_path / f"stage{i}"
        spark.createDataFrame([row], ddl).coalesce(1).write.parquet(str(stage_dir))
        [f] = [x for x in os.listdir(stage_dir) if x.endswith(".parquet")]
        os.link(stage_dir / f, tmp_path / f"t-{i}-snappy.parquet")
    paths = [str(tmp_path / f"t-{i}-snappy.parquet") for i in (1, 2)]
    with pytest.raises(SchemaMismatch):
        read_parts(spark, paths, layout="flat")


def test_max_records_per_file_splits_files_not_rows(spark, tmp_path):
    import os

    from partweave.operators.bind import write_table

    path = str(tmp_path / "capped")
    write_table(spark.range(100).coalesce(1), path, max_records_per_file=30)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 4 and spark.read.parquet(path).count() == 100


def test_footers_as_a_table(spark, tmp_path):
    from partweave.sources.csv import list_parts
    from partweave.sources.parts import _check_by_reading, check_part_schemas, part_footers

    path = str(tmp_path / "t")
    spark.range(10).select((F.col("id") % 2).alias("part"), "id").write.partitionBy("part").parquet(path)
    files = list_parts(spark, path, "(.*)", "*.parquet")
    rows = part_footers(files).collect()
    assert sum(r.n_rows for r in rows) == 10 and {r["columns"] for r in rows} == {"id int64"} and not any(r.error for r in rows)
    lost = part_footers(spark.createDataFrame([("nowhere:/x.parquet",), ("/not/there.parquet",)], "path string")).collect()
    assert all(r.error and r.n_rows is None for r in lost)
    check_part_schemas(spark, files)
    _check_by_reading(spark, [f"{path}/part=0", f"{path}/part=1"])
    spark.range(3).select(F.col("id").cast("int").alias("id")).write.parquet(f"{path}/part=2")
    with pytest.raises(SchemaMismatch):
        check_part_schemas(spark, list_parts(spark, path, "(.*)", "*.parquet"))
    with pytest.raises(SchemaMismatch):
        _check_by_reading(spark, [f"{path}/part={i}" for i in range(3)])


def test_headers_opened_and_scanned_are_alike(spark, tmp_path):
    from partweave.sources.csv import _heads

    (tmp_path / "t_1.csv").write_text("\ufeffPatID,Source\r\n1,a\r\n")
    (tmp_path / "t_2.csv").write_text("Source,PatID\n" + "b,2\n" * 5000)
    (tmp_path / "t_x.csv").write_text("other\n")
    a, b = (_heads(spark, str(tmp_path), r"t_(\d+)\.csv", "t_*.csv", opened=o).collect() for o in (True, False))
    assert [r["head"] for r in a] == [r["head"] for r in b] == ["PatID,Source", "Source,PatID"]
    assert [len(r.paths) for r in a] == [len(r.paths) for r in b] == [1, 1]
