"""The integration against a brute-force pandas model of its semantics, on
random overlapping parts with NULL and orphan keys (hypothesis)."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from partweave.plans.pipeline import Pipeline


def _model(demo, fac, enc, dx, how="inner"):
    """Reference semantics: new ID = rank over (part, old id), NULLs last;
    each rewrite an inner join on (part, old id); encounter keys rewritten
    before its IDs are used (the cascade)."""

    def rebase(df, col):
        d = df.copy()
        d["_null"] = d[col].isna()
        d = d.sort_values(["part", "_null", col], kind="mergesort").reset_index(drop=True)
        d["_new_" + col] = range(1, len(d) + 1)
        return d.drop(columns="_null")

    def keymap(df, col):
        return df[["part", col, "_new_" + col]].rename(columns={col: "_old", "_new_" + col: "_new"})

    d = rebase(demo, "PatID")
    f = rebase(fac, "FacilityID")
    e = rebase(enc, "EncounterID")
    kd, kf = keymap(d, "PatID"), keymap(f, "FacilityID")

    def rewrite(child, col, km):
        # NULL keys never match (SQL semantics; pandas would pair NULL with NULL)
        keyed, nulls = child.dropna(subset=[col]), child[child[col].isna()]
        m = keyed.merge(km, left_on=["part", col], right_on=["part", "_old"], how=how)
        m = m.drop(columns=[col, "_old"]).rename(columns={"_new": col})
        if how == "left" and len(nulls):
            m = pd.concat([m, nulls.assign(**{col: pd.NA})], ignore_index=True)
        return m

    e2 = rewrite(rewrite(e, "PatID", kd), "FacilityID", kf)
    ke = keymap(e2, "EncounterID")
    x = rewrite(rewrite(dx, "PatID", kd), "EncounterID", ke)
    out = x[["EncounterID", "PatID", "code"]].astype(object).where(x[["EncounterID", "PatID", "code"]].notna(), None)
    return sorted(map(tuple, out.values.tolist()), key=_order)


def _order(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


@pytest.mark.filterwarnings("ignore:The behavior of DataFrame concatenation:FutureWarning")
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.explicit, Phase.generate])
@given(seed=st.integers(0, 10_000), n_parts=st.integers(1, 3), how=st.sampled_from(["inner", "left"]))
def test_integration_matches_model(spark, seed, n_parts, how):
    rnd = random.Random(seed)
    demo, fac, enc, dx = [], [], [], []
    for p in range(1, n_parts + 1):
        pats = rnd.sample(range(1, 30), rnd.randint(2, 8))
        facs = rnd.sample(range(1, 10), rnd.randint(1, 3))
        demo += [(p, i, rnd.choice("MF")) for i in pats]
        fac += [(p, i) for i in facs]
        encs = rnd.sample(range(1, 50), rnd.randint(1, 10))
        for eid in encs:
            pat = rnd.choice(pats + [99, None])  # 99: orphan, None: NULL key
            fc = rnd.choice(facs + [None])
            enc.append((p, eid, pat, fc))
            for k in range(rnd.randint(0, 3)):
                dx.append((p, rnd.choice([eid, eid, 77]), rnd.choice([pat, rnd.choice(pats)]), f"c{k}"))
    cols = {
        "demo": ("part long, PatID long, Sex string", ["part", "PatID", "Sex"], demo),
        "fac": ("part long, FacilityID long", ["part", "FacilityID"], fac),
        "enc": ("part long, EncounterID long, PatID long, FacilityID long", ["part", "EncounterID", "PatID", "FacilityID"], enc),
        "dx": ("part long, EncounterID long, PatID long, code string", ["part", "EncounterID", "PatID", "code"], dx),
    }
    sdf = {k: spark.createDataFrame(rows, ddl) for k, (ddl, _, rows) in cols.items()}
    pdf = {k: pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in names if c not in ("Sex", "code")}) for k, (_, names, rows) in cols.items()}
    p = Pipeline({"demographic": sdf["demo"], "facility": sdf["fac"], "encounter": sdf["enc"], "diagnosis": sdf["dx"]}, how=how)
    got = sorted(((r.EncounterID, r.PatID, r.code) for r in p.output("diagnosis").collect()), key=_order)
    want = _model(pdf["demo"], pdf["fac"], pdf["enc"], pdf["dx"], how)
    assert got == want
