import pytest
from pyspark.sql import functions as F

from partweave.operators.ids import (
    DuplicateOwnerKeys,
    check_ids,
    fan_out,
    key_map,
    part_offsets,
    rebase_ids,
)
from partweave.operators.keys import orphans, rewrite_fk


@pytest.fixture()
def owner(spark):
    rows = [(1, 10, "a"), (1, 11, "b"), (1, 12, "c"), (2, 10, "d"), (2, 13, "e")]
    return spark.createDataFrame(rows, "part long, PatID long, name string")


@pytest.fixture()
def child(spark):
    rows = [(1, 10, "x1"), (1, 12, "x2"), (2, 10, "x3"), (2, 99, "orphan"), (1, None, "null"), (2, 13, "x4")]
    return spark.createDataFrame(rows, "part long, PatID long, what string")


def test_part_offsets_count_earlier_parts(owner):
    got = {r.part: (r.n_rows, r.start_id) for r in part_offsets(owner).collect()}
    assert got == {1: (3, 1), 2: (2, 4)}


@pytest.mark.parametrize("method", ["two_pass", "segments", "window"])
def test_rebase_is_dense_and_keeps_old_id(owner, method):
    rb = rebase_ids(owner, "PatID", method=method)
    assert rb.columns == ["part", "OrigPatID", "name", "PatID"]
    got = {(r.part, r.OrigPatID): r.PatID for r in rb.collect()}
    assert got == {(1, 10): 1, (1, 11): 2, (1, 12): 3, (2, 10): 4, (2, 13): 5}
    chk = check_ids(rb, "PatID").first()
    assert (chk.n_rows, chk.n_distinct, chk.min_id, chk.max_id, chk.n_null, chk.is_dense) == (5, 5, 1, 5, 0, True)


def test_duplicate_owner_key_fails_or_fans_out(spark):
    dup = spark.createDataFrame([(1, 5), (1, 5), (1, 6)], "part long, PatID long")
    assert [tuple(r) for r in fan_out(dup, "PatID").collect()] == [(1, 5, 2)]
    with pytest.raises(DuplicateOwnerKeys):
        rebase_ids(dup, "PatID")
    kept = rebase_ids(dup, "PatID", on_duplicates="keep")
    assert sorted(r.PatID for r in kept.collect()) == [1, 2, 3]


def test_null_owner_id_gets_an_id_but_matches_nothing(spark):
    own = spark.createDataFrame([(1, None), (1, 6)], "part long, PatID long")
    rb = rebase_ids(own, "PatID")
    got = {r.OrigPatID: r.PatID for r in rb.collect()}
    assert got == {6: 1, None: 2}
    ch = spark.createDataFrame([(1, None, "n"), (1, 6, "ok")], "part long, PatID long, w string")
    out = rewrite_fk(ch, key_map(rb, "PatID"), "PatID")
    assert [(r.PatID, r.w) for r in out.collect()] == [(1, "ok")]


@pytest.mark.parametrize("broadcast", ["auto", "never"])
def test_rewrite_inner_drops_orphans_and_puts_key_first(owner, child, broadcast):
    km = key_map(rebase_ids(owner, "PatID"), "PatID")
    out = rewrite_fk(child, km, "PatID", broadcast=broadcast)
    assert out.columns == ["PatID", "part", "what"]
    got = sorted((r.what, r.PatID) for r in out.collect())
    assert got == [("x1", 1), ("x2", 3), ("x3", 4), ("x4", 5)]
    orph = sorted(r.what for r in orphans(child, km, "PatID").collect())
    assert orph == ["null", "orphan"]
    assert out.count() + len(orph) == child.count()


def test_rewrite_left_keeps_orphans_with_null(owner, child):
    km = key_map(rebase_ids(owner, "PatID"), "PatID")
    out = {r.what: r.PatID for r in rewrite_fk(child, km, "PatID", how="left").collect()}
    assert out["orphan"] is None and out["null"] is None and out["x1"] == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_split_matches_plain_join(spark, owner, how):
    hot = spark.range(0, 500).select(F.lit(1).cast("long").alias("part"), F.lit(10).cast("long").alias("PatID"), F.col("id").cast("string").alias("what"))
    cold = spark.createDataFrame([(2, 13, "c"), (2, 77, "orphan"), (2, None, "null")], "part long, PatID long, what string")
    ch = hot.unionByName(cold)
    km = key_map(rebase_ids(owner, "PatID"), "PatID")
    a = rewrite_fk(ch, km, "PatID", how=how, broadcast="never")
    b = rewrite_fk(ch, km, "PatID", how=how, broadcast="never", hot_key_rows=100)
    assert a.count() == (501 if how == "inner" else 503)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_part_is_part_of_the_key(spark):
    """Old IDs overlap across parts: joining without the part multiplies rows."""
    own = spark.createDataFrame([(1, 1), (2, 1)], "part long, PatID long")
    ch = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "part long, PatID long, w string")
    out = rewrite_fk(ch, key_map(rebase_ids(own, "PatID"), "PatID"), "PatID")
    assert sorted((r.w, r.PatID) for r in out.collect()) == [("a", 1), ("b", 2)]


def test_window_method_falls_back_for_big_parts(spark, owner):
    """The window method only runs while every part fits one task; above the
    bound the exact two-pass method takes over with the same numbers."""
    a = {(r.part, r.OrigPatID): r.PatID for r in rebase_ids(owner, "PatID", method="window").collect()}
    stats = {}
    b = {(r.part, r.OrigPatID): r.PatID for r in rebase_ids(owner, "PatID", method="window", max_group_rows=2, stats=stats).collect()}
    assert a == b and stats["rows"] == 5


def test_kept_duplicates_number_the_same_on_rerun(spark):
    dup = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 6, "c")], "part long, PatID long, s string")
    a = {r.s: r.PatID for r in rebase_ids(dup, "PatID", on_duplicates="keep").collect()}
    b = {r.s: r.PatID for r in rebase_ids(dup.orderBy("s"), "PatID", on_duplicates="keep").collect()}
    assert a == b and sorted(a.values()) == [1, 2, 3] and a["c"] == 3


@pytest.mark.parametrize("keys_only", [True, False])
def test_keys_only_and_full_row_numbering_agree(spark, keys_only):
    from partweave.operators.ids import assign_ids

    rows = [(p, i, None if i == 3 and p == 2 else f"v{i}", i * 2, i * 3, i * 4, i * 5) for p in (1, 2) for i in (5, 3, 9)]
    wide = spark.createDataFrame(rows, "part long, PatID long, a string, b long, c long, d long, e long")
    wide = wide.union(spark.createDataFrame([(2, None, "n", 0, 0, 0, 0)], wide.schema))
    rb, km = assign_ids(wide, "PatID", keys_only=keys_only)
    assert rb.columns == ["part", "OrigPatID", "a", "b", "c", "d", "e", "PatID"]
    got = {(r.part, r.OrigPatID): r.PatID for r in rb.collect()}
    assert got == {(1, 3): 1, (1, 5): 2, (1, 9): 3, (2, 3): 4, (2, 5): 5, (2, 9): 6, (2, None): 7}
    assert {(r.part, r.OrigPatID): r.PatID for r in km.collect()} == got
