import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partweave.plans.catalog import pipeline
from partweave.plans.fixtures import fixture
from partweave.plans.pipeline import Pipeline
from partweave.registry import CLAIMS, ForeignKey, Registry

# FIXTURES.md, sf0.001 column (death, dispensing, procedure: from the DuckDB
# oracle of bound_row_counts_all).
EXPECTED_SF0001 = {
    "death": 135,
    "dispensing": 5143,
    "procedure": 4249,
    "demographic": 135,
    "facility": 22,
    "provider": 48,
    "encounter": 1106,
    "diagnosis": 4249,
    "enrollment": 1339,
}


def test_key_order_puts_encounter_after_its_parents():
    assert CLAIMS.key_order() == ["PatID", "ProviderID", "FacilityID", "EncounterID"]
    assert CLAIMS.keys_of("diagnosis") == ["PatID", "ProviderID", "EncounterID"]
    assert CLAIMS.keys_of("encounter") == ["PatID", "FacilityID"]


def test_cycle_is_refused():
    r = Registry(
        tables=("a", "b"),
        owners={"a": "AID", "b": "BID"},
        foreign_keys=(ForeignKey("a", "BID", "b"), ForeignKey("b", "AID", "a")),
    )
    with pytest.raises(ValueError):
        r.key_order()


def test_outputs_counts_and_shape(spark, sf001):
    p = pipeline(spark, sf001)
    outs = p.outputs()
    assert {t: df.count() for t, df in outs.items()} == EXPECTED_SF0001
    for t, df in outs.items():
        assert "part" not in df.columns
        assert not [c for c in df.columns if c.startswith("Orig")], t
    assert outs["diagnosis"].columns[:3] == ["EncounterID", "ProviderID", "PatID"]
    assert outs["procedure"].columns[:3] == ["EncounterID", "ProviderID", "PatID"]
    assert outs["dispensing"].columns[:2] == ["ProviderID", "PatID"]
    assert outs["death"].columns[0] == "PatID"
    assert outs["enrollment"].columns[0] == "PatID"
    assert outs["encounter"].columns[:2] == ["FacilityID", "PatID"]
    assert outs["encounter"].columns[-1] == "EncounterID"
    assert outs["demographic"].columns[-1] == "PatID"


def test_ids_dense_at_assignment_gaps_after_cascade(spark, sf001):
    p = pipeline(spark, sf001)
    for owner, col in CLAIMS.owners.items():
        r = p.rebased(owner).agg(F.min(col), F.max(col), F.count_distinct(col), F.count(F.lit(1))).first()
        assert r[0] == 1 and r[1] == r[2] == r[3]
    enc = p.output("encounter").agg(F.min("EncounterID"), F.max("EncounterID")).first()
    assert tuple(enc) == (6, 1499)


def test_rows_in_equal_rows_out_plus_orphans(spark, sf001):
    fx = fixture(spark, sf001)
    p = pipeline(spark, sf001)
    n_in = fx.enroll_src.count()
    n_out = p.output("enrollment").count()
    n_orph = p.orphans("enrollment", "PatID").count()
    assert n_in == n_out + n_orph


def test_window_and_two_pass_pipelines_agree(spark, sf001):
    a = Pipeline(fixture(spark, sf001).tables(), method="two_pass").output("diagnosis")
    b = Pipeline(fixture(spark, sf001).tables(), method="window").output("diagnosis")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_write_outputs(spark, sf001, tmp_path):
    p = pipeline(spark, sf001)
    paths = p.write(str(tmp_path / "out"))
    back = spark.read.parquet(paths["enrollment"])
    assert back.count() == EXPECTED_SF0001["enrollment"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    n_parts=st.integers(min_value=1, max_value=4),
    seed=st.integers(min_value=0, max_value=10_000),
)
def test_any_split_gives_unsplit_coverage(spark, n_parts, seed):
    """A consistent dataset split into overlapping parts (local IDs restart in
    every part), rebased and bound, gives the coverage of the unsplit data."""
    import random

    rnd = random.Random(seed)
    people = [(g, rnd.choice("MF"), rnd.choice(["1", "2", "3"])) for g in range(40)]
    spans = [(rnd.randrange(40), rnd.choice("YN"), rnd.choice("YN")) for _ in range(150)]
    part_of = {g: rnd.randrange(n_parts) + 1 for g, _, _ in people}
    local = {}
    for p in range(1, n_parts + 1):
        members = [g for g, _, _ in people if part_of[g] == p]
        rnd.shuffle(members)
        local.update({g: i + 1 for i, g in enumerate(members)})
    demo = spark.createDataFrame(
        [(part_of[g], local[g], s, r) for g, s, r in people], "part long, PatID long, Sex string, Race string"
    )
    enr = spark.createDataFrame(
        [(part_of[g], local[g], m, d) for g, m, d in spans], "part long, PatID long, MedCov string, DrugCov string"
    )
    p = Pipeline({"demographic": demo, "enrollment": enr})
    j = p.output("demographic").join(p.output("enrollment"), "PatID")
    got = {tuple(r) for r in j.where("MedCov = 'Y' AND DrugCov = 'Y'").groupBy("Sex", "Race").count().collect()}
    truth = {}
    sex = {g: (s, r) for g, s, r in people}
    for g, m, d in spans:
        if m == "Y" and d == "Y":
            truth[sex[g]] = truth.get(sex[g], 0) + 1
    assert got == {(s, r, n) for (s, r), n in truth.items()}


def test_owners_numbered_together_match_one_by_one(spark, sf001):
    from partweave.operators.ids import assign_ids, assign_ids_many

    fx = fixture(spark, sf001)
    owners = {"demographic": (fx.demo_src, "PatID"), "provider": (fx.prov_src, "ProviderID"), "facility": (fx.fac_src, "FacilityID")}
    together = assign_ids_many(owners)
    for name, (df, col) in owners.items():
        rb, km, rows = together[name]
        alone, _ = assign_ids(df, col)
        assert rb.columns == alone.columns
        assert rb.exceptAll(alone).count() == 0 and alone.exceptAll(rb).count() == 0
        assert rows == df.count() == km.count()


def test_duplicate_in_one_owner_names_it(spark):
    import pytest as _pytest

    from partweave.operators.ids import DuplicateOwnerKeys, assign_ids_many

    ok = spark.createDataFrame([(1, 1), (1, 2)], "part long, PatID long")
    bad = spark.createDataFrame([(1, 7), (1, 7)], "part long, ProviderID long")
    with _pytest.raises(DuplicateOwnerKeys, match="provider"):
        assign_ids_many({"demographic": (ok, "PatID"), "provider": (bad, "ProviderID")})


def test_pipeline_with_owners_numbered_together(spark, sf001):
    a = Pipeline(fixture(spark, sf001).tables(), number_owners_together=True).output("diagnosis")
    b = pipeline(spark, sf001).output("diagnosis")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_missing_key_column_is_named_up_front(spark):
    demo = spark.createDataFrame([(1, 1)], "part long, PatID long")
    enr = spark.createDataFrame([(1, "Y")], "part long, MedCov string")
    with pytest.raises(KeyError, match="enrollment.*PatID"):
        Pipeline({"demographic": demo, "enrollment": enr}).output("enrollment")
    no_part = spark.createDataFrame([(1,)], "PatID long")
    with pytest.raises(KeyError, match="demographic.*part"):
        Pipeline({"demographic": no_part}).output("demographic")


def test_audit_rows_in_equal_rows_out_plus_orphans(spark, sf001):
    p = pipeline(spark, sf001)
    audit = {(r.table_name, r.id_col): (r.rows_in, r.orphans) for r in p.audit().collect()}
    assert len(audit) == 12
    for t in ("death", "enrollment"):  # one key each: exact balance
        rows_in, orph = audit[(t, "PatID")]
        assert rows_in - orph == p.output(t).count()
    enc_out = p.output("encounter").count()
    for k in ("PatID", "FacilityID"):
        rows_in, orph = audit[("encounter", k)]
        assert enc_out <= rows_in - orph


def test_declared_output_order(spark):
    """Columns named in ``output_order`` come first, in its order and in any case; others as they came."""
    from partweave.registry import ForeignKey, Registry

    demo = spark.createDataFrame([(1, 5, "F", 1990)], "part long, PatID long, Sex string, Born int")
    enr = spark.createDataFrame([(1, "Y", 5, "N")], "part long, MedCov string, PatID long, DrugCov string")
    tables = {"demographic": demo, "enrollment": enr}
    keys = (("demographic", "enrollment"), {"demographic": "PatID"}, (ForeignKey("enrollment", "PatID", "demographic"),))
    plain = Pipeline(tables, Registry(*keys))
    assert plain.output("demographic").columns == ["Sex", "Born", "PatID"]
    assert plain.output("enrollment").columns == ["PatID", "MedCov", "DrugCov"]
    told = Pipeline(tables, Registry(*keys, output_order={"demographic": ("patid", "BORN"), "enrollment": ("DrugCov",)}))
    assert told.output("demographic").columns == ["PatID", "Born", "Sex"]
    assert tuple(told.output("demographic").first()) == (1, 1990, "F")
    assert told.output("enrollment").columns == ["DrugCov", "PatID", "MedCov"]


def test_audit_with_repeated_owner_keys(spark):
    """Copies of an owner key multiply its children, but each child row is counted once."""
    from partweave.registry import ForeignKey, Registry

    demo = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 6, "c"), (2, 5, "d")], "part long, PatID long, v string")
    enr = spark.createDataFrame([(1, 5), (1, 5), (1, 7), (2, 6), (2, None)], "part long, PatID long")
    reg = Registry(("demographic", "enrollment"), {"demographic": "PatID"}, (ForeignKey("enrollment", "PatID", "demographic"),))
    p = Pipeline({"demographic": demo, "enrollment": enr}, reg, on_duplicates="keep")
    assert [tuple(r) for r in p.audit().collect()] == [("enrollment", "PatID", 5, 3)]
    assert p.output("enrollment").count() == 4
