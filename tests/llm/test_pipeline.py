"""The corpus pipeline: each stage's rows, and awkward input."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from partweave.session import stage
from partweave.llm.queries import ORACLES, QUERIES


def run_stages(spark, docs):
    seen = [docs]
    for name, step in corpus_pipeline.STAGES:
        seen.append(stage(step(spark, seen[-1], ""), f"test-{name}"))
    return seen


def test_stages_on_awkward_rows(spark, awkward):
    start, read, lines, near, mixed, packed = run_stages(spark, awkward)
    assert all(x.columns == awkward.columns for x in (read, lines, near, mixed))
    ids = lambda df: sorted(r.doc_id if r.doc_id is not None else -1 for r in df.collect())
    assert ids(read) == [-1, -1, 1, 2, 3, 4, 5, 10, 11, 11, 12, 13]
    assert ids(lines) == [-1, 1, 5, 10, 11, 11, 12, 13]
    assert ids(near) == ids(lines)
    assert set(ids(mixed)) == set(ids(near))
    pieces = packed.toPandas()
    assert (pieces.length > 0).all() and pieces.groupby("sequence_id").length.sum().max() <= 4096
    assert mixed.where(F.length("text") != F.col("n_chars")).count() == 0


def test_stages_on_an_empty_table(spark, nothing):
    seen = run_stages(spark, nothing)
    assert len(seen) == 6 and all(x.count() == 0 for x in seen)
    assert all(x.columns == nothing.columns for x in seen[:-1])


def test_which_stage_catches_which_copies(spark):
    """Exact copies and near copies lose their lines to the line stage; texts that were cut into other
    lines are left to the near-duplicate stage. Clean documents pass both."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8)))
    lines = lambda n: [[word() for _ in range(14)] for _ in range(n)]
    rows, clean = [], []
    for i in range(12):
        text = lines(6)
        near = [[*line[:7], word(), *line[8:]] for line in text]  # a word changed in each line: 13 of 15 are shared
        flat = [w for line in text for w in line]
        other = [flat[k : k + 9] for k in range(0, len(flat), 9)]  # the same words in other lines
        for k, t in enumerate((text, text, near, other)):
            rows.append((10 * i + k, "\n".join(" ".join(line) for line in t)))
        rows.append((10 * i + 9, "\n".join(" ".join(line) for line in lines(5))))
        clean += [10 * i, 10 * i + 9]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    read = corpus_pipeline.language_id(spark, docs, "")
    kept = stage(corpus_pipeline.line_dedup(spark, read, ""), "test-lines")
    near = stage(corpus_pipeline.near_dedup(spark, kept, ""), "test-near")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(read) == sorted(i for i, _ in rows)
    assert ids(kept) == sorted([*clean, *(10 * i + 3 for i in range(12))])
    assert ids(near) == sorted(clean)


def test_one_query_for_each_operator():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in QUERIES) == 1
    assert set(ORACLES) <= set(QUERIES)


def test_sql_of_the_operators(spark):
    """The queries with a SQL form equal it over a whole small table."""
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    for name, sql in ORACLES.items():
        got, want = QUERIES[name](spark, d), con.execute(sql)
        columns = [c[0] for c in want.description]
        assert sorted(got.columns) == sorted(columns), name
        rows = [sorted(tuple(map(str, r)) for r in x) for x in (got.select(columns).collect(), want.fetchall())]
        assert rows[0] == rows[1], name
