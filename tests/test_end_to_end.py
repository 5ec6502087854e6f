"""The reference flow end to end: numbered extract files whose IDs arrive as
floats -> landed parts -> integrated, bound tables -> coverage query."""

import os

from pyspark.sql import functions as F

from partweave.operators.rollups import coverage_count
from partweave.plans.convert import integrate, land_tables
from partweave.plans.fixtures import fixture
from tests.conftest import duck_views

import __spark_entry__ as E


def _write_extracts(spark, fx, src_dir):
    """One CSV file per (table, part), IDs as floats, named <table>_<i>.csv."""
    for table in ("demographic", "enrollment"):
        df = fx.tables()[table]
        ids = [c for c in df.columns if c.lower().endswith("id")]
        df = df.select(*[F.col(c).cast("double").alias(c) if c in ids else F.col(c) for c in df.columns])
        for (p,) in df.select("part").distinct().collect():  # five parts: a test-side loop
            pdf = df.where(F.col("part") == p).drop("part").toPandas()
            pdf.to_csv(os.path.join(src_dir, f"{table}_{p}.csv"), index=False)


def test_extracts_to_bound_tables(spark, sf001, duck, tmp_path):
    src = tmp_path / "data"
    src.mkdir()
    fx = fixture(spark, sf001)
    _write_extracts(spark, fx, str(src))
    landed = land_tables(spark, str(src), str(tmp_path / "landing"), fmt="csv", tables=["demographic", "enrollment"])
    assert set(landed) == {"demographic", "enrollment"}
    back = spark.read.parquet(landed["demographic"])
    assert dict(back.dtypes)["PatID"] == "bigint"
    outs = integrate(spark, str(tmp_path / "landing"), str(tmp_path / "output"), tables=["demographic", "enrollment"])
    demo, enr = spark.read.parquet(outs["demographic"]), spark.read.parquet(outs["enrollment"])
    assert "part" not in demo.columns and "OrigPatID" not in demo.columns
    # CSV columns land as text unless a schema declares them.
    by = ["Sex", "Hispanic", F.col("Race").cast("int").alias("Race")]
    got = coverage_count(demo, enr, on="PatID", by=by, flags={"MedCov": "Y", "DrugCov": "Y"})
    duck_views(duck, sf001)
    want = {tuple(r) for r in duck.execute(E.oracle_sql()["coverage_after_rebase"]).fetchall()}
    assert {tuple(r) for r in got.collect()} == want


def test_cli_describe_and_count(spark, tmp_path, capsys):
    from partweave.__main__ import main

    path = str(tmp_path / "t")
    spark.range(1234).withColumnRenamed("id", "PatID").write.parquet(path)
    main(["count", path])
    main(["describe", path])
    out = capsys.readouterr().out
    assert "1,234" in out and "BIGINT" in out


def test_cli_land_integrate_coverage(spark, sf001, tmp_path, capsys):
    from partweave.__main__ import main

    src = tmp_path / "data"
    src.mkdir()
    _write_extracts(spark, fixture(spark, sf001), str(src))
    main(["land", str(src), str(tmp_path / "landing"), "--format", "csv", "--tables", "demographic,enrollment"])
    main([
        "integrate", str(tmp_path / "landing"), str(tmp_path / "out"), "--tables", "demographic,enrollment",
        "--hot-key-rows", "50", "--max-records-per-file", "500", "--broadcast-max-bytes", "1000",
    ])
    capsys.readouterr()
    main(["coverage", str(tmp_path / "out/demographic"), str(tmp_path / "out/enrollment"), "--by", "Sex,Race"])
    out = capsys.readouterr().out
    assert "Sex" in out and "Race" in out and "count" in out


def test_cli_landing_with_a_manifest_grows_and_resumes(spark, sf001, tmp_path, capsys):
    from partweave.__main__ import main

    src, landing = tmp_path / "data", str(tmp_path / "landing")
    src.mkdir()
    late = tmp_path / "late"
    late.mkdir()
    _write_extracts(spark, fixture(spark, sf001), str(src))
    for f in os.listdir(src):
        if f.endswith(("_4.csv", "_5.csv")):
            os.rename(src / f, late / f)
    land = ["land", str(src), landing, "--format", "csv", "--tables", "demographic,enrollment", "--manifest"]
    main(land)
    first = spark.read.parquet(f"{landing}/demographic").count()
    main(land)  # nothing to add
    assert spark.read.parquet(f"{landing}/demographic").count() == first
    for f in os.listdir(late):
        os.rename(late / f, src / f)
    main(land)
    main(["integrate", landing, str(tmp_path / "out"), "--tables", "demographic,enrollment", "--manifest", "--prefilter", "--broadcast-max-bytes", "1000"])
    fx = fixture(spark, sf001)
    assert spark.read.parquet(str(tmp_path / "out/demographic")).count() == fx.demo_src.count()
    capsys.readouterr()
    main(["losses", landing])
    lines = capsys.readouterr().out.split()
    assert lines[0].startswith("table_name,part,column_name") and len(lines) == 1 + 10
    main(["profile", str(tmp_path / "out/demographic"), "--columns", "PatID,Sex"])
    assert "PatID,BIGINT,1.0" in capsys.readouterr().out
