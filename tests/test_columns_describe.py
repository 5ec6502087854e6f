import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from partweave.operators.columns import cast_ids_by_suffix, id_columns, rename_orig
from partweave.operators.profiles import from_sketches, profile_table, sketch_columns, union_sketches, value_counts
from partweave.operators.describe import describe_columns, profile_column, row_count
from partweave.operators.rollups import code_year_rollup


def test_cast_ids_by_suffix_case_insensitive_truncating(spark):
    df = spark.createDataFrame(
        [(1.0, 7.0, "a"), (None, float("nan"), "b"), (1.7, -1.7, "c")], "PatID double, zipId double, name string"
    )
    assert id_columns(df) == ["PatID", "zipId"]
    out = cast_ids_by_suffix(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "bigint", "string"]
    assert [tuple(r) for r in out.orderBy("name").collect()] == [(1, 7, "a"), (None, None, "b"), (1, -1, "c")]


def test_rename_orig(spark):
    df = spark.createDataFrame([(1, 2)], "PatID long, x long")
    assert rename_orig(df, "PatID").columns == ["OrigPatID", "x"]


def test_code_year_rollup_null_is_a_group(spark):
    rows = [
        ("A", "09", dt.date(2009, 1, 1)),
        ("A", "09", dt.date(2009, 5, 1)),
        ("A", "09", dt.date(2010, 1, 1)),
        (None, "09", dt.date(2010, 2, 1)),
        ("B", "10", None),
    ]
    df = spark.createDataFrame(rows, "DX string, DX_codetype string, ADate date")
    got = {tuple(r) for r in code_year_rollup(df, "DX", "DX_codetype", "ADate").collect()}
    assert got == {("A", "09", 2009, 2), ("A", "09", 2010, 1), (None, "09", 2010, 1), ("B", "10", None, 1)}
    last = code_year_rollup(df, "DX", "DX_codetype", "ADate", sort="nulls_last").collect()
    first = code_year_rollup(df, "DX", "DX_codetype", "ADate", sort="nulls_first").collect()
    assert last[-1].year is None and first[0].year is None


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_profile_of_one_null_three(spark, duck, mode):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    p = profile_column(df, "x", quantiles=mode).first()
    assert (p.min, p.max, p.n_unique, p["count"]) == (1, 3, 2, 3)
    assert p.avg == 2.0 and math.isclose(p.std, 1.414214)
    assert p.null_percentage == 33.33
    if mode == "exact":
        ref = duck.execute(
            "SELECT quantile_cont(x, 0.25), quantile_cont(x, 0.5), quantile_cont(x, 0.75) FROM (VALUES (1), (NULL), (3)) t(x)"
        ).fetchone()
        assert (p.q25, p.q50, p.q75) == tuple(ref) == (1.5, 2.0, 2.5)
    else:
        assert p.q25 in (1.0, 3.0) and p.q75 in (1.0, 3.0)


def test_profile_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x int")
    p = profile_column(df, "x").first()
    assert p["count"] == 2 and p.q50 is None and p.null_percentage == 100.0


def test_row_count_and_describe(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2020, 1, 1))] * 1234, "id long, s string, t timestamp_ntz")
    assert row_count(df).first()["count"] == 1234
    assert row_count(df, formatted=True).first()["count"] == "1,234"
    got = [tuple(r) for r in describe_columns(df).collect()]
    assert got == [("id", "BIGINT"), ("s", "VARCHAR"), ("t", "TIMESTAMP")]


def test_profile_by_group_matches_duckdb(spark, duck):
    rows = [(1, 5), (1, 1), (1, None), (1, 9), (2, 4), (2, 4), (3, None)]
    df = spark.createDataFrame(rows, "part long, x long")
    got = {r.part: (r.q25, r.q50, r.q75, r["count"], r.null_percentage, r.n_unique) for r in profile_column(df, "x", by=["part"]).collect()}
    duck.execute("CREATE OR REPLACE TABLE t(part BIGINT, x BIGINT)")
    duck.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = {
        r[0]: tuple(r[1:])
        for r in duck.execute(
            "SELECT part, quantile_cont(x, 0.25), quantile_cont(x, 0.5), quantile_cont(x, 0.75), count(*), "
            "round(100.0 * (count(*) - count(x)) / count(*), 2), count(DISTINCT x) FROM t GROUP BY part"
        ).fetchall()
    }
    assert got == want


def test_suffix_rule_catches_paid_unless_excluded(spark):
    df = spark.createDataFrame([(1.0, 12.5)], "PatID double, Paid double")
    assert id_columns(df) == ["PatID", "Paid"]
    out = cast_ids_by_suffix(df, exclude=("paid",))
    assert dict(out.dtypes) == {"PatID": "bigint", "Paid": "double"}


def test_profile_quantiles_of_a_hot_value(spark, duck):
    """90% of rows share one value: it is one row after the partial count, and the quantiles are exact."""
    df = spark.range(0, 4000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(7)).alias("x"))
    counts = value_counts(df.repartition(8), ["x"])
    assert {r["_v"]: r["_n"] for r in counts.where("_n > 1").collect()} == {7.0: 3600}
    p = profile_column(df.repartition(8), "x").first()
    duck.execute("CREATE OR REPLACE TABLE hv AS SELECT CASE WHEN i % 10 = 0 THEN i ELSE 7 END AS x FROM range(4000) t(i)")
    want = duck.execute("SELECT quantile_cont(x, 0.25), quantile_cont(x, 0.5), quantile_cont(x, 0.75) FROM hv").fetchone()
    assert (p.q25, p.q50, p.q75) == tuple(want)


def test_profile_within_brackets(spark, duck):
    """More rows than need no bracket: skewed and repeated values, an outlier, NaN-free doubles, groups."""
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(5.5)).when(F.col("id") == 59_999, F.lit(1e15)).otherwise(F.sqrt("id")).alias("x"),
    )
    duck.execute(
        "CREATE OR REPLACE TABLE br AS SELECT i % 3 AS g, CASE WHEN i % 2 = 0 THEN 5.5 WHEN i = 59999 THEN 1e15 ELSE sqrt(i) END AS x FROM range(60000) t(i)"
    )
    sql = "round(quantile_cont(x, 0.25), 6), round(quantile_cont(x, 0.5), 6), round(quantile_cont(x, 0.75), 6), count(DISTINCT x) FROM br"
    p = profile_column(df, "x").first()
    assert (p.q25, p.q50, p.q75, p.n_unique) == duck.execute(f"SELECT {sql}").fetchone()
    got = {(r.g, r.q25, r.q50, r.q75, r.n_unique) for r in profile_table(df, ["x"], by=["g"]).collect()}
    assert got == set(duck.execute(f"SELECT g, {sql} GROUP BY g").fetchall())


def test_profile_of_all_columns(spark):
    rows = [(1, 2.5, "b", dt.date(2020, 1, 2)), (3, None, "a", None), (2**60, 0.5, "b", dt.date(2019, 1, 1)), (None, 1.0, None, None)]
    df = spark.createDataFrame(rows, "i long, d double, s string, t date")
    for mode in ("exact", "sketch"):
        got = {r.column_name: r for r in profile_table(df, quantiles=mode).collect()}
        assert [got[c].n_unique for c in "idst"] == [3, 3, 2, 2]
        assert [got[c].column_type for c in "idst"] == ["BIGINT", "DOUBLE", "VARCHAR", "DATE"]
        assert [got[c].null_percentage for c in "idst"] == [25.0, 25.0, 25.0, 50.0]
        assert (got["s"].min_text, got["s"].max_text, got["t"].min_text, got["s"].avg, got["s"].q50) == ("a", "b", "2019-01-01", None, None)
        assert (got["d"].min_number, got["d"].max_number, got["d"].avg) == (0.5, 2.5, 1.333333)
        assert got["d"].q50 == 1.0
    empty = profile_table(df.limit(0)).collect()
    assert len(empty) == 4 and all(r["count"] == 0 and r.n_unique == 0 and r.q50 is None for r in empty)


def test_sketches_of_parts_merge_within_their_error(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("part"), (F.col("id") * 7919 % 40_000).alias("x"), F.concat(F.lit("v"), F.col("id") % 9000).alias("s"))
    kept = [sketch_columns(df.where(F.col("part") == p), ["x", "s"]) for p in range(4)]
    got = {r.column_name: r for r in from_sketches(union_sketches(kept)).collect()}
    assert abs(got["x"].n_unique - 40_000) < 3 * 0.016 * 40_000 and abs(got["s"].n_unique - 9000) < 3 * 0.016 * 9000
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert abs(got["x"][name] - p * 40_000) < 0.01 * 40_000
    assert got["x"]["count"] == 40_000 and abs(got["x"].avg - 19_999.5) < 1e-6 and abs(got["x"].std - 11547.14972) < 1e-3
