"""Plan shapes that the scale design relies on, checked on executed plans."""

import __spark_entry__ as E
import partweave.operators.numbering as N
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbering_stage_has_one_exchange_and_one_sort(spark, monkeypatch):
    seen = {}
    real = N.stage

    def spy(df, tag):
        if tag == "numbering":
            seen["plan"] = _plan(df)
        return real(df, tag)

    monkeypatch.setattr(N, "stage", spy)
    df = spark.range(1000).select((F.col("id") % 3).alias("part"), F.col("id").alias("k"))
    N.number_rows(df, ["part", "k"], "n", on_ties="fail")
    plan = seen["plan"]
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    assert plan.count("Sort [") == 1  # the duplicate-check window reuses the sort
    assert "Window" in plan


def test_coverage_filter_and_columns_reach_the_scan(spark, sf001):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # no "..." in the plan text
    try:
        plan = _plan(E.queries()["coverage_count"](spark, sf001))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(o_orderstatus,F)" in plan and "EqualTo(o_orderpriority,1-URGENT)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan


def test_bound_diagnosis_joins_are_all_broadcast(spark, sf001):
    plan = _plan(E.queries()["rewrite_fk_diagnosis"](spark, sf001))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 3


def test_rollup_aggregates_before_the_shuffle(spark, sf001):
    plan = _plan(E.queries()["code_year_rollup"](spark, sf001))
    assert "partial_count" in plan and plan.count("Exchange") == 1


def test_no_numbering_in_a_full_run_shuffles_twice(spark, sf001, monkeypatch):
    """Every numbering stage of a full fixture + integration run has nothing
    but its range shuffle above its input (the tie-check window included)."""
    from partweave.operators.describe import profile_column
    from partweave.plans.fixtures import Fixture
    from partweave.plans.pipeline import Pipeline

    above = []
    real = N.stage

    def spy(df, tag):
        if tag == "numbering":
            lines = _plan(df).splitlines()
            cut = next(i for i, line in enumerate(lines) if "rangepartitioning" in line)
            above.append([line for line in lines[:cut] if "Exchange" in line])
        return real(df, tag)

    monkeypatch.setattr(N, "stage", spy)
    p = Pipeline(Fixture(spark, sf001).tables())
    for df in p.outputs().values():
        df.count()
    profile_column(p.rebased("demographic"), "PatID", by=["part"]).collect()
    assert len(above) >= 5 and all(a == [] for a in above), above


def test_big_key_map_joins_stay_splittable_under_a_hot_key(spark, sf001):
    """A key map over the broadcast budget: both sides of the child join are
    shuffled by the planner, which is what adaptive execution can split; hot keys
    split up front give the same rows, as does the broadcast plan."""
    from pyspark.sql import functions as F

    from partweave.plans.fixtures import Fixture
    from partweave.plans.pipeline import Pipeline

    fx = Fixture(spark, sf001)
    tables = {t: fx.tables()[t] for t in ("demographic", "enrollment")}
    one = tables["enrollment"].where("PatID = 2 and part = 1").limit(1)
    hot = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("copy")
    tables["enrollment"] = tables["enrollment"].unionByName(hot)
    big, ref = Pipeline(tables, broadcast_max_bytes=100), Pipeline(tables)
    salted = Pipeline(tables, broadcast_max_bytes=100, hot_key_rows=500)
    a, b, c = (p.output("enrollment") for p in (big, ref, salted))
    assert a.count() == b.count() == c.count() > 2000
    for x in (a, c):
        assert x.exceptAll(b).count() == 0 and b.exceptAll(x).count() == 0
    assert "_salt" in _plan(c) and "_salt" not in _plan(a)
    lines = _plan(a).splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin [part" in line)
    assert sum("ENSURE_REQUIREMENTS" in line for line in lines[at:]) >= 2
