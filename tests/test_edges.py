"""Edge cases: empty inputs, a single part, all-NULL keys."""

from partweave.operators.describe import profile_column
from partweave.operators.ids import assign_ids, check_ids, rebase_ids
from partweave.operators.keys import rewrite_fk
from partweave.plans.pipeline import Pipeline


def test_empty_owner_and_child(spark):
    own = spark.createDataFrame([], "part long, PatID long, s string")
    ch = spark.createDataFrame([], "part long, PatID long, w string")
    rb, km = assign_ids(own, "PatID")
    assert rb.count() == 0 and km.count() == 0
    assert rewrite_fk(ch, km, "PatID").count() == 0
    p = Pipeline({"demographic": own, "enrollment": ch})
    assert p.output("enrollment").count() == 0


def test_single_part(spark):
    own = spark.createDataFrame([(7, i) for i in (30, 10, 20)], "part long, PatID long")
    got = sorted((r.OrigPatID, r.PatID) for r in rebase_ids(own, "PatID").collect())
    assert got == [(10, 1), (20, 2), (30, 3)]


def test_all_null_owner_ids(spark):
    own = spark.createDataFrame([(1, None)], "part long, PatID long")
    rb = rebase_ids(own, "PatID")
    assert [(r.OrigPatID, r.PatID) for r in rb.collect()] == [(None, 1)]
    chk = check_ids(rb, "PatID").first()
    assert chk.is_dense and chk.n_null == 0


def test_profile_of_empty(spark):
    p = profile_column(spark.createDataFrame([], "x long"), "x").first()
    assert p["count"] == 0 and p.q50 is None and p.null_percentage is None
