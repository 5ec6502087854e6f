"""Tables created from queries: snapshots, replacement, dropping."""

import pytest
from pyspark.sql import functions as F

from partweave.operators.tables import TableExists, create_table_as, current_version, drop_table, expire_versions
from partweave.session import new_stage_path


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def name(spark):
    yield "pw_t_made"
    drop_table(spark, "pw_t_made")


def test_rows_stay_when_the_source_is_rewritten(spark, name):
    src = new_stage_path(spark, "ctas-src")
    spark.range(5).write.parquet(src)
    made = create_table_as(spark, name, f"SELECT id, id * 2 AS twice FROM parquet.`{src}`")
    spark.range(90, 91).write.mode("overwrite").parquet(src)
    assert values(made) == values(spark.table(name)) == [(i, 2 * i) for i in range(5)]


def test_replace_takes_other_columns_and_may_read_itself(spark, name):
    create_table_as(spark, name, spark.range(3))
    first = current_version(spark, name)
    old = spark.table(name)
    create_table_as(spark, name, f"SELECT id + 10 AS n, 'x' AS s FROM {name}", mode="replace")
    assert values(spark.table(name)) == [(10, "x"), (11, "x"), (12, "x")]
    assert values(old) == [(0,), (1,), (2,)]  # the older version is still there for who reads it
    assert expire_versions(spark, name) == [first]
    assert values(spark.table(name)) == [(10, "x"), (11, "x"), (12, "x")]


def test_a_failing_query_leaves_the_table(spark, name):
    create_table_as(spark, name, spark.range(2))
    with pytest.raises(Exception, match="on purpose"):
        create_table_as(spark, name, spark.range(9).select(F.raise_error(F.lit("on purpose")).alias("x")), mode="replace")
    assert values(spark.table(name)) == [(0,), (1,)]
    assert expire_versions(spark, name) == []


def test_modes_and_names(spark, name):
    create_table_as(spark, name, spark.range(2))
    with pytest.raises(TableExists):
        create_table_as(spark, name, spark.range(3))
    assert create_table_as(spark, name, spark.range(3), mode="ignore").count() == 2
    for bad in ("a b", "x;drop", "a.b.c", ""):
        with pytest.raises(ValueError):
            create_table_as(spark, bad, spark.range(1))
    with pytest.raises(ValueError):
        create_table_as(spark, name, spark.range(1), mode="append")


def test_partitions_keep_the_column_order_and_drop_deletes_files(spark, name):
    df = spark.range(4).select((F.col("id") % 2).alias("part"), "id")
    made = create_table_as(spark, name, df, partition_by=["part"])
    assert made.columns == ["part", "id"] and values(made) == [(0, 0), (0, 2), (1, 1), (1, 3)]
    where = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {current_version(spark, name)}").collect()}["Location"]
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    drop_table(spark, name)
    with pytest.raises(Exception, match="(?i)not found|cannot be found"):
        drop_table(spark, name, if_exists=False)
