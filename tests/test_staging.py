"""Staged tables and when they go."""

import pytest
from pyspark.sql import functions as F

from partweave.session import new_stage_path, stage, stage_alone


def exists(spark, path):
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    return to.getFileSystem(spark._jsc.hadoopConfiguration()).exists(to)


def folder(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_inner_tables_go_when_the_result_is_written(spark):
    before = stage(spark.range(3), "before")
    inner = []

    def make():
        inner.append(stage(before.withColumn("x", F.col("id") + 1), "inner"))
        inner.append(stage(inner[0].where("x > 1"), "inner"))
        return inner[-1].select("x")

    folders = []
    out = stage_alone(spark, lambda: (df := make(), folders.extend(map(folder, inner)))[0], "outer")
    assert sorted(r.x for r in out.collect()) == [2, 3] and before.count() == 3
    assert len(folders) == 2 and not any(exists(spark, f) for f in folders)


def test_nested_calls_and_failures_clean_up(spark):
    seen = []

    def inner():
        seen.append(folder(stage(spark.range(2), "deep")))
        return spark.range(5)

    def outer():
        df = stage_alone(spark, inner, "middle")
        seen.append(folder(df))
        assert df.count() == 5 and not exists(spark, seen[0])
        return df.where("id > 3")

    assert stage_alone(spark, outer, "top").count() == 1
    assert not exists(spark, seen[1])

    def fails():
        seen.append(folder(stage(spark.range(2), "lost")))
        raise RuntimeError("on purpose")

    with pytest.raises(RuntimeError):
        stage_alone(spark, fails, "never")
    assert not exists(spark, seen[-1])
    path = new_stage_path(spark, "free")
    spark.range(1).write.parquet(path)
    assert exists(spark, path)
