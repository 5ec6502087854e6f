"""Writes by part: rows are not sorted by folder, and every row arrives."""

import pytest
from partweave.plans.catalog import _numbered_files
from partweave.session import unsorted_folders
from partweave.sources.parts import write_parts
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def test_folder_writes_set_the_number_of_open_files_and_reset_it(spark):
    with unsorted_folders(spark):
        assert int(spark.conf.get(WRITERS)) > 0
        with unsorted_folders(spark):
            pass
        assert int(spark.conf.get(WRITERS)) > 0
    assert int(spark.conf.get(WRITERS, "0")) == 0
    spark.conf.set(WRITERS, "3")
    try:
        with unsorted_folders(spark):
            assert spark.conf.get(WRITERS) == "3"
        assert spark.conf.get(WRITERS) == "3"
    finally:
        spark.conf.unset(WRITERS)


def test_parts_beyond_the_open_files_are_written_whole(spark, tmp_path):
    df = spark.range(0, 5000, 1, 2).select((F.col("id") % 70).alias("part"), "id")
    write_parts(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.select(F.col("part").cast("long"), "id").exceptAll(df).count() == 0 and back.count() == 5000
    assert back.select("part").distinct().count() == 70


def test_folder_writes_do_not_sort(spark, tmp_path, monkeypatch):
    """Spark leaves out the sort by folder while files may be open together."""
    seen = []
    for kind in ("parquet", "csv"):
        real = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda self, path, real=real: (seen.append(int(spark.conf.get(WRITERS, "0"))), real(self, path))[1])
    df = spark.range(20).select((F.col("id") % 3).alias("part"), "id")
    write_parts(df, str(tmp_path / "a"))
    _numbered_files(df, str(tmp_path / "b"), "death", "csv")
    assert len(seen) == 3 and min(seen) > 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_numbered_files_are_one_a_part_even_where_a_task_has_many(spark, tmp_path, fmt):
    df = spark.range(0, 3000, 1, 3).select((F.col("id") % 45).alias("part"), "id")
    _numbered_files(df, str(tmp_path / "t"), "death", fmt)
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("death"))
    assert len(names) == 45
    read = spark.read.parquet(str(tmp_path / "t")) if fmt == "parquet" else spark.read.option("header", "true").csv(str(tmp_path / "t"))
    assert sorted(int(r.id) for r in read.select("id").collect()) == list(range(3000))
