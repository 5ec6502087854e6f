"""Large joins keep what a task holds small, and give the same rows."""

import partweave.operators.broadcast as B
import partweave.plans.fixtures as X
import pytest
from partweave.operators.broadcast import hashed
from partweave.operators.ids import key_map, rebase_ids
from partweave.operators.keys import orphans, rewrite_fk


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def owner_and_child(spark):
    owner = spark.createDataFrame([(p, i) for p in (1, 2) for i in range(1, 40)], "part long, PatID long")
    rows = [(p, i, f"{p}-{i}-{n}") for p in (1, 2, 3) for i in range(1, 45) for n in (1, 2)] + [(1, None, "null"), (1, None, "null")]
    return owner, spark.createDataFrame(rows, "part long, PatID long, what string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_key_maps_are_hashed_and_the_child_is_not_sorted(spark, owner_and_child, monkeypatch, how):
    owner, child = owner_and_child
    km = key_map(rebase_ids(owner, "PatID"), "PatID")
    ref = rewrite_fk(child, km, "PatID", how=how, broadcast="never")
    monkeypatch.setattr(B, "HASHED_ROWS", 50)
    out = rewrite_fk(child, km, "PatID", how=how, keymap_rows=78, broadcast_max_bytes=100)
    assert "ShuffledHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
    assert sorted(out.collect(), key=str) == sorted(ref.collect(), key=str)


def test_orphans_by_a_hashed_and_by_a_broadcast_key_map(spark, owner_and_child, monkeypatch):
    owner, child = owner_and_child
    km = key_map(rebase_ids(owner, "PatID"), "PatID")
    ref = sorted(orphans(child, km, "PatID").collect(), key=str)
    monkeypatch.setattr(B, "HASHED_ROWS", 50)
    large = orphans(child, km, "PatID", keymap_rows=78, broadcast_max_bytes=100)
    small = orphans(child, km, "PatID", keymap_rows=78)
    assert "ShuffledHashJoin" in _plan(large) and "BroadcastHashJoin" in _plan(small)
    assert sorted(large.collect(), key=str) == sorted(small.collect(), key=str) == ref and len(ref) > 2


def test_unknown_and_small_sides_are_left_to_spark(spark):
    df = spark.range(3)
    assert hashed(df, None) is df and hashed(df, 3) is df


def test_large_fixture_joins_lines_in_bounded_tasks(spark, sf001, monkeypatch):
    small = X.Fixture(spark, sf001)
    want = small.dx_src
    monkeypatch.setattr(X, "HASHED_ROWS", 1000)
    monkeypatch.setattr(X, "ENCOUNTERS_A_TASK", 100)
    plans = []
    real = X.stage
    monkeypatch.setattr(X, "stage", lambda df, tag: (plans.append(_plan(df)), real(df, tag))[1])
    large = X.Fixture(spark, sf001).dx_src
    n = small.enc_src.count()
    assert n >= 1000 and f", {-(-n // 100)}), REPARTITION_BY_NUM" in plans[0]
    assert large.exceptAll(want).count() == 0 and want.exceptAll(large).count() == 0
