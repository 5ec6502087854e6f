import pandas as pd
import pytest
from pyspark.sql import functions as F

from partweave.operators.numbering import number_rows


def _frame(spark, rows, schema="part long, id long, v string"):
    return spark.createDataFrame(rows, schema)


def test_global_numbering_is_dense_in_order(spark):
    rows = [(p, i, f"{p}-{i}") for p in (3, 1, 2) for i in (50, 7, 9, 1000)]
    out = number_rows(_frame(spark, rows), ["part", "id"], "n").toPandas()
    out = out.sort_values("n")
    assert out["n"].tolist() == list(range(1, 13))
    assert list(zip(out.part, out.id)) == sorted(zip(out.part, out.id))


def test_restart_numbering_restarts_per_group(spark):
    rows = [(p, i, "x") for p in (1, 2) for i in range(p * 5)]
    out = number_rows(_frame(spark, rows), ["id"], "n", restart_by=["part"]).toPandas()
    for p, g in out.groupby("part"):
        g = g.sort_values("id")
        assert g["n"].tolist() == list(range(1, len(g) + 1))


def test_two_pass_agrees_with_window(spark):
    rows = [(p, (i * 7919) % 1000, "x") for p in (1, 2, 3) for i in range(300)]
    df = _frame(spark, rows).dropDuplicates(["part", "id"])
    a = number_rows(df, ["id"], "n", restart_by=["part"]).select("part", "id", "n")
    b = number_rows(df, ["id"], "n", restart_by=["part"], method="window").select("part", "id", "n")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_nulls_are_numbered_last(spark):
    df = _frame(spark, [(1, None, "a"), (1, 5, "b"), (1, 2, "c")])
    out = {r.v: r.n for r in number_rows(df, ["part", "id"], "n").collect()}
    assert out == {"c": 1, "b": 2, "a": 3}


def test_hot_part_is_spread_over_partitions(spark):
    """One part holds almost all rows: the range partitioner must still cut it
    into many partitions rather than give it to one task."""
    hot = spark.range(0, 20000).select(F.lit(1).cast("long").alias("part"), F.col("id"), F.lit("x").alias("v"))
    cold = spark.range(0, 100).select(F.lit(2).cast("long").alias("part"), F.col("id"), F.lit("y").alias("v"))
    df = hot.unionByName(cold)
    from partweave.operators.numbering import PID, sort_keys

    sizes = (
        df.repartitionByRange(8, *sort_keys(["part", "id"]))
        .groupBy(F.spark_partition_id().alias(PID))
        .count()
        .toPandas()
    )
    assert sizes["count"].max() < 0.5 * 20100
    out = number_rows(df, ["part", "id"], "n")
    agg = out.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(agg) == (1, 20100, 20100)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        number_rows(_frame(spark, [(1, 1, "a")]), ["id"], "n", method="nope")
    with pytest.raises(ValueError):
        number_rows(_frame(spark, [(1, 1, "a")]), ["id"], "n", method="window")


def test_staged_segment_fallback_matches(spark, monkeypatch):
    """More segments than may be broadcast: shuffle-joined."""
    import partweave.operators.numbering as N

    rows = [(p, i, "x") for p in range(1, 7) for i in range(20)]
    df = _frame(spark, rows)
    want = {(r.part, r.id): r.n for r in number_rows(df, ["id"], "n", restart_by=["part"]).collect()}
    monkeypatch.setattr(N, "BROADCAST_SEGMENTS", 1)
    stats = {}
    got = {(r.part, r.id): r.n for r in number_rows(df, ["id"], "n", restart_by=["part"], stats=stats).collect()}
    assert got == want and stats["rows"] == 120
    assert sorted(v for (p, _), v in got.items() if p == 3) == list(range(1, 21))


def test_hot_duplicate_key_is_caught(spark):
    from partweave.operators.numbering import DuplicateKeys

    hot = spark.range(0, 3000).select(F.lit(1).cast("long").alias("part"), F.lit(7).cast("long").alias("id"), F.lit("h").alias("v"))
    rest = spark.range(0, 3000).select(F.lit(1).cast("long").alias("part"), (F.col("id") + 100).alias("id"), F.lit("c").alias("v"))
    with pytest.raises(DuplicateKeys):
        number_rows(hot.unionByName(rest), ["part", "id"], "n", on_ties="fail")
    stats = {}
    out = number_rows(rest, ["part", "id"], "n", on_ties="fail", stats=stats)
    assert stats["rows"] == 3000 and out.agg(F.max("n")).first()[0] == 3000


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.integers(1, 4), st.one_of(st.none(), st.integers(-50, 50))),
        min_size=1,
        max_size=60,
        unique=True,
    )
)
def test_numbering_equals_pandas_rank(spark, rows):
    df = spark.createDataFrame([(p, i, "x") for p, i in rows], "part long, id long, v string")
    got = {(r.part, r.id): r.n for r in number_rows(df, ["id"], "n", restart_by=["part"]).collect()}
    pdf = pd.DataFrame(rows, columns=["part", "id"])
    pdf["key"] = [10**9 if pd.isna(i) else i for i in pdf["id"]]  # NULLs last
    pdf["n"] = pdf.groupby("part")["key"].rank(method="first").astype(int)
    want = {(p, None if pd.isna(i) else int(i)): n for p, i, n in zip(pdf.part, pdf.id, pdf.n)}
    assert got == want


def _both(spark, df, order, restart=(), rows=None):
    from partweave.operators.segments import number_by_segments

    got, n = number_by_segments(df, order, "n", list(restart), rows)
    want = number_rows(df, order, "n", restart_by=list(restart))
    assert got.columns == want.columns and n == df.count()
    return got, want


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_segments_agree_with_two_pass(spark, rows):
    """Even, clustered far from zero, negative and NULL keys; groups of any size."""
    even = spark.range(0, 400).select(F.lit(1).alias("part"), F.col("id"))
    far = spark.range(0, 300).select(F.lit(2).alias("part"), (F.col("id") * 3 + 10**18).alias("id"))
    low = spark.range(0, 200).select(F.lit(3).alias("part"), (F.col("id") * F.col("id") * -977 - 2**62).alias("id"))
    odd = spark.createDataFrame([(None, 4), (2, None), (3, None), (3, -(2**63)), (3, 2**63 - 1)], "part int, id long")
    df = even.union(far).union(low).union(odd).withColumn("v", F.col("id") * 0)
    for order, restart in ((["part", "id"], []), (["id"], ["part"])):
        got, want = _both(spark, df, order, restart, rows)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_segments_of_dates_and_repeats(spark):
    df = spark.range(0, 500).select(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("id") * 37).cast("int")).alias("d"))
    got, want = _both(spark, df, ["d"], [], 40)
    assert got.exceptAll(want).count() == 0
    hot = spark.range(0, 300).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id")).cast("long").alias("k"))
    got, _ = _both(spark, hot, ["k"], [], 20)
    numbers = sorted((r.n, r.k) for r in got.collect())
    assert [n for n, _ in numbers] == list(range(1, 301)) and [k for _, k in numbers] == sorted(k for _, k in numbers)


def test_segments_stage_the_histogram_alone(spark, monkeypatch):
    import partweave.operators.segments as S

    written = []
    real = S.stage
    monkeypatch.setattr(S, "stage", lambda df, tag: written.append(df.columns) or real(df, tag))
    df = spark.range(0, 5000).withColumn("payload", F.lit("x"))
    out = number_rows(df, ["id"], "n", method="segments", on_ties="fail", stats=(stats := {}))
    assert stats["rows"] == 5000 and out.where("n <> id + 1").count() == 0
    assert written and not any("payload" in c for c in written)
    empty = number_rows(df.limit(0), ["id"], "n", method="segments")
    assert empty.count() == 0 and empty.columns == ["id", "payload", "n"]


def test_segments_refuse_what_they_cannot_cut(spark):
    from partweave.operators.numbering import DuplicateKeys

    df = _frame(spark, [(1, 1, "a"), (1, 1, "b")])
    with pytest.raises(ValueError, match="whole number"):
        number_rows(df, ["v"], "n", method="segments")
    with pytest.raises(DuplicateKeys):
        number_rows(df, ["part", "id"], "n", method="segments", on_ties="fail")
