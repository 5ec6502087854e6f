from pyspark.sql import functions as F

from partweave.operators.broadcast import checked_broadcast, is_at_most, max_rows_for, row_bytes
from partweave.operators.ids import key_map, rebase_ids
from partweave.operators.keys import rewrite_fk


def _broadcast_joins(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def _has_broadcast(df):
    return _broadcast_joins(df) > 0


def test_is_at_most_and_row_width(spark):
    df = spark.range(100)
    assert is_at_most(df, 100) and not is_at_most(df, 99)
    assert row_bytes(df.schema) == 16
    assert max_rows_for(df, 1600) == 100


def test_checked_broadcast_only_under_budget(spark):
    small, big = spark.range(10), spark.range(5000)
    probe = spark.range(100).withColumnRenamed("id", "k")
    j_small = probe.join(checked_broadcast(small), probe.k == F.col("id"))
    j_big = probe.join(checked_broadcast(big, max_bytes=1000), probe.k == F.col("id"))
    assert _has_broadcast(j_small)
    assert not _has_broadcast(j_big)


def test_rewrite_respects_known_size_and_budget(spark):
    own = spark.createDataFrame([(1, i) for i in range(50)], "part long, PatID long")
    ch = spark.createDataFrame([(1, i, "x") for i in range(50)], "part long, PatID long, w string")
    km = key_map(rebase_ids(own, "PatID"), "PatID")
    # The key map itself carries one broadcast join (numbering offsets).
    inner = _broadcast_joins(km)
    assert _broadcast_joins(rewrite_fk(ch, km, "PatID", keymap_rows=50)) == inner + 1
    assert _broadcast_joins(rewrite_fk(ch, km, "PatID", keymap_rows=50, broadcast_max_bytes=100)) == inner
    assert rewrite_fk(ch, km, "PatID", keymap_rows=50, broadcast_max_bytes=100).count() == 50
