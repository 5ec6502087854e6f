import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partweave.session import new_stage_path
from partweave.streaming.landing import land_stream, part_row_counts, read_part_stream


def _drop_part(spark, src, table, i, n):
    tmp = new_stage_path(spark, "stream-src")
    spark.range(n).select((F.col("id") + 0.5).alias("PatID"), F.lit(f"x{i}").alias("s")).coalesce(1).write.parquet(tmp)
    [f] = [x for x in os.listdir(tmp.replace("file:", "")) if x.endswith(".parquet")]
    os.link(os.path.join(tmp.replace("file:", ""), f), os.path.join(src, f"{table}-{i}-snappy.parquet"))


def test_land_stream_incremental_and_exactly_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    out = str(tmp_path / "out")
    ckpt = str(tmp_path / "ckpt")
    st = StructType.fromDDL("PatID double, s string")
    _drop_part(spark, str(src), "enrollment", 1, 5)
    _drop_part(spark, str(src), "enrollment", 12, 3)
    q = land_stream(spark, str(src), out, st, checkpoint=ckpt)
    q.awaitTermination(120)
    _drop_part(spark, str(src), "enrollment", 2, 4)
    q = land_stream(spark, str(src), out, st, checkpoint=ckpt)  # restart: only the new file
    q.awaitTermination(120)
    landed = spark.read.parquet(out)
    assert dict(landed.dtypes)["PatID"] == "bigint"
    counts = {r.part: r["count"] for r in landed.groupBy("part").count().collect()}
    assert counts == {1: 5, 12: 3, 2: 4}


def test_part_row_counts_stateful(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    st = StructType.fromDDL("PatID double, s string")
    _drop_part(spark, str(src), "demographic", 3, 7)
    _drop_part(spark, str(src), "demographic", 4, 2)
    counts = part_row_counts(read_part_stream(spark, str(src), st, max_files_per_trigger=1))
    q = counts.writeStream.format("memory").queryName("pw_part_counts").outputMode("complete").start()
    q.processAllAvailable()
    got = {r.part: r.n_rows for r in spark.sql("SELECT * FROM pw_part_counts").collect()}
    q.stop()
    assert got == {3: 7, 4: 2}


def test_a_stray_file_fails_the_stream(spark, tmp_path):
    """As it fails the batch reader: it must not land under no part."""
    src = tmp_path / "in"
    src.mkdir()
    _drop_part(spark, str(src), "enrollment", 1, 2)
    os.rename(src / "enrollment-1-snappy.parquet", src / "enrollment-one.parquet")
    q = land_stream(spark, str(src), str(tmp_path / "out"), StructType.fromDDL("PatID double, s string"), checkpoint=str(tmp_path / "c"))
    with pytest.raises(Exception, match="not named as a part"):
        q.awaitTermination(120)


def test_the_stream_leaves_excluded_columns(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _drop_part(spark, str(src), "enrollment", 1, 2)
    out = str(tmp_path / "out")
    land_stream(spark, str(src), out, StructType.fromDDL("PatID double, s string"), checkpoint=str(tmp_path / "c"), exclude=("patid",)).awaitTermination(120)
    assert dict(spark.read.parquet(out).dtypes)["PatID"] == "double"
