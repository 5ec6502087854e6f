"""Vector search: brute force, recall, awkward rows."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from partweave.llm import vectors
from partweave.llm.ann import REACH, SAMPLE, Tables, _best_first, hashes_for, nearest, neighbour_cosine
from partweave.llm.topk import exact_top_k

DDL = "vec_id long, embedding array<double>, label int"
EVEN = "id % 2 = 0"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rows = [
        (0, [0.5, -0.25, 0.0]),
        (1, [0.5, -0.25, 0.0]),
        (2, [0.5, -0.25, 0.0]),
        (3, [1.0, 2.0]),
        (4, []),
        (5, None),
        (6, [1.0, None, 2.0]),
        (7, [float("nan"), 1.0, 1.0]),
        (8, [float("inf"), 1.0, 1.0]),
        (9, [0.0, 0.0, 0.0]),
        (None, [1.0, 1.0, 1.0]),
        (11, [-3.0, 0.1, 0.7]),
        (12, [1e300, 1.0, 1.0]),
        (12, [0.25, 0.25, 0.25]),
    ]
    return spark.createDataFrame([(i, v, None) for i, v in rows], DDL)


def scored(rows, measure, k=5):
    out = []
    for q, (i, x) in enumerate(rows):
        if i % 2 == 0:
            best = sorted((-measure(x, y), j, c) for c, (j, y) in enumerate(rows) if c != q)[:k]
            out += [(i, r, j, -s) for r, (s, j, _) in enumerate(best, 1)]
    return sorted(out)


def usable(df):
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    return [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def test_exact_top_k_of_awkward_rows(spark, odd_vectors, monkeypatch):
    def product(x, y):
        s = sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y))
        return max(-(1 << 63), min((1 << 63) - 1, s))

    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_top_k(odd_vectors, EVEN).collect())
    assert got == scored(usable(odd_vectors), product)
    assert exact_top_k(odd_vectors.limit(0), EVEN).count() == 0


def test_query_batches_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4)], 0) for i in range(60)]
    rows += [(i, v, 1) for i, v, _ in rows[:7]]  # repeated rows meet each other
    df = spark.createDataFrame(rows, DDL)
    top, near = sorted(map(tuple, exact_top_k(df, EVEN).collect())), rounded(nearest(df, EVEN).collect())
    monkeypatch.setattr(vectors, "QUERY_BYTES", 700)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    assert sorted(map(tuple, exact_top_k(df, EVEN).collect())) == top
    assert rounded(nearest(df, EVEN).collect()) == near
    assert top == scored([(i, v) for i, v, _ in rows], lambda x, y: sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y)))


def test_search_takes_clashing_names_and_long_vectors(spark):
    rng = np.random.default_rng(6)
    long = [[float(x) for x in rng.normal(size=n)] for n in (60_000, 50_000, 3)]
    rows = [(i, long[i % 3], 1, 2, 3) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int, score int, bucket int")

    def product(x, y):
        n = min(len(x), len(y))
        return int(np.floor(256 * np.array(x[:n])).astype(np.int64) @ np.floor(256 * np.array(y[:n])).astype(np.int64))

    pairs = [(i, v) for i, v, *_ in rows]
    assert sorted(map(tuple, exact_top_k(df, EVEN).collect())) == scored(pairs, product)
    assert rounded(nearest(df, EVEN).collect()) == rounded(scored(pairs, lambda x, y: cosine(x, y)))


def test_probes_come_in_falling_order():
    rng = np.random.default_rng(9)
    for _ in range(20):
        slots = [sorted(((float(p), i) for i, p in enumerate(rng.dirichlet(np.ones(4)))), reverse=True) for _ in range(4)]
        got = list(_best_first(slots))
        every = sorted((math.prod(s[i][0] for s, i in zip(slots, at)) for at in itertools.product(range(4), repeat=4)), reverse=True)
        share = [math.prod(dict((b, a) for a, b in s)[i] for s, i in zip(slots, at)) for at in got]
        assert np.allclose(share, every[: len(share)]) and len({tuple(x) for x in got}) == len(got)
        assert sum(share) >= REACH > sum(share[:-1])


def test_nearest_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = nearest(df, F.col("id") % 50 == 0).toPandas()
    pdf = df.toPandas()
    x, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    size = np.sqrt((x * x).sum(axis=1))
    hit = total = 0
    for q, one in got.groupby("query_id"):
        i = int(np.flatnonzero(ids == q)[0])
        s = x @ x[i] / (size * size[i])
        s[i] = -2
        hit += len(set(ids[np.lexsort((ids, -s))[:5]]) & set(one.vec_id))
        total += 5
        by_id = dict(zip(ids, s))
        assert np.allclose(one.score, [by_id[v] for v in one.vec_id], atol=1e-12)
        assert one.sort_values("rank").score.is_monotonic_decreasing
    assert total == len(got) and hit / total >= 0.9
    # The share of all rows that a query meets, beside its recall.
    units = x / size[:, None]
    tables = Tables(x.shape[1], hashes_for(len(x)), neighbour_cosine(units[:SAMPLE], 5))
    own = tables.buckets(units)
    visited = [np.zeros(len(x), bool) for _ in range(40)]
    for i, seen in enumerate(visited):
        for t, codes in tables.probes(units[i]):
            seen |= np.isin(own[t], codes)
    print(f"recall {hit / total:.3f}, visited {np.mean(visited):.3f} of the rows, {hashes_for(len(x))} hashes")


def test_nearest_of_awkward_rows(odd_vectors):
    got = nearest(odd_vectors, EVEN).collect()
    first = {r.query_id: (r.vec_id, round(r.score, 9)) for r in got if r.rank == 1}
    assert first[0] == (1, 1.0) and first[2] == (0, 1.0)
    assert not {4, 5, 6, 7, 8, 9, None} & ({r.vec_id for r in got} | {r.query_id for r in got})
    assert nearest(odd_vectors.limit(0), EVEN).count() == 0


def cosine(x, y):
    return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))


def rounded(rows):
    return sorted((q, r, i, round(s, 9)) for q, r, i, s in rows)


@pytest.mark.parametrize("n", range(2, 7))
def test_nearest_of_small_tables_is_whole(spark, n):
    rows = [(i, [(-1.0) ** i * (8.0 + i), 0.1 * i, 0.3]) for i in range(n)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    assert rounded(nearest(df, EVEN).collect()) == rounded(scored(rows, cosine))


def test_outliers_beside_copies_get_all_neighbours(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(3, 16))
    rows = [(i, (centre[i % 3] + 1e-6 * rng.normal(size=16)).tolist()) for i in range(9000)]
    rows += [(i, rng.normal(size=16).tolist()) for i in range(9000, 9040)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    got = nearest(df, "id >= 9000 or id < 6").toPandas()
    assert set(got.query_id) == {*range(6), *range(9000, 9040)} and (got.groupby("query_id").size() == 5).all()


def test_visits_reach_the_estimated_share():
    """Planted neighbours at the tables' cosine are found about as often as the estimate says."""
    rng = np.random.default_rng(2)
    tables = Tables(32, 3, 0.5)
    hits = 0
    for _ in range(300):
        q, u = rng.normal(size=32), rng.normal(size=32)
        q /= np.linalg.norm(q)
        u -= (u @ q) * q
        x = 0.5 * q + math.sqrt(0.75) * u / np.linalg.norm(u)
        at = tables.buckets(x[None])
        hits += sum(at[t][0] in codes for t, codes in tables.probes(q))
    assert 0.8 < hits / 600 < 0.97
