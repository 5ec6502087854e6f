"""The ledger, the manifest, compact key maps and bitmaps."""

import pytest
from pyspark.sql import functions as F

from partweave.operators.compact import compact_key_map, key_filter
from partweave.operators.ids import check_ids, key_map, rebase_ids
from partweave.operators.keys import rewrite_fk
from partweave.session import new_stage_path
from partweave.sources.manifest import SchemaChanged, land_new_parts, losses, read_landed, read_manifest
from partweave.streaming.ledger import Ledger, LedgerConflict, PartChanged, rebase_new_parts, rebase_stream


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def owner(spark):
    return spark.range(0, 60).select((F.col("id") % 4 + 1).alias("part"), (F.col("id") * 7 % 61).alias("PatID"), F.concat(F.lit("p"), "id").alias("name"))


def ledger(spark):
    return Ledger(spark, new_stage_path(spark, "ledger"))


def test_two_runs_equal_one(spark, owner):
    book = ledger(spark)
    first = rows(rebase_new_parts(owner.where("part <= 2"), "PatID", book, "demographic"))
    again = rows(rebase_new_parts(owner.where("part <= 2"), "PatID", book, "demographic"))
    second = rows(rebase_new_parts(owner.where("part > 2"), "PatID", book, "demographic", method="segments"))
    assert first == again and sorted(first + second) == rows(rebase_ids(owner, "PatID"))
    assert book.read().count() == 4
    # Both runs in one plan: each reads the ledger as it was in its turn.
    book = ledger(spark)
    early = rebase_new_parts(owner.where("part <= 2"), "PatID", book, "demographic")
    late = rebase_new_parts(owner.where("part > 2"), "PatID", book, "demographic")
    assert rows(early.unionByName(late)) == rows(rebase_ids(owner, "PatID"))


def test_late_part_counts_on_and_changed_part_is_refused(spark, owner):
    book = ledger(spark)
    rebase_new_parts(owner.where("part = 3"), "PatID", book, "d").count()
    late = rebase_new_parts(owner.where("part = 1"), "PatID", book, "d")
    assert late.agg(F.min("PatID"), F.max("PatID")).first() == (16, 30)
    both = rows(rebase_new_parts(owner.where("part in (1, 3)"), "PatID", book, "d"))
    assert sorted(r[-1] for r in both) == list(range(1, 31))
    with pytest.raises(PartChanged):
        rebase_new_parts(owner.where("part = 1").limit(3), "PatID", book, "d")
    assert rebase_new_parts(owner.where("part = 9"), "PatID", book, "d").count() == 0
    spark.createDataFrame([("d", 8, 5, 29)], book.read().schema).write.mode("append").parquet(book.path)
    with pytest.raises(LedgerConflict):
        book.check("d")


def test_rebase_stream_in_two_starts(spark, owner):
    book, src, out, place = ledger(spark), *(new_stage_path(spark, f"ledger-{x}") for x in ("src", "out", "ckpt"))
    seen = []
    for some in ("part <= 3", "part = 4"):
        owner.where(some).write.mode("append").partitionBy("part").parquet(src)
        stream = spark.readStream.schema("PatID long, name string, part long").parquet(src)
        rebase_stream(stream, "PatID", book, "demographic", out, checkpoint=place, after=lambda df, n: seen.append(n)).awaitTermination()
    got = spark.read.parquet(out).select("part", "OrigPatID", "name", "PatID")
    assert rows(got) == rows(rebase_ids(owner, "PatID")) and seen == [0, 1]


def test_landing_twice_adds_nothing_and_a_cut_one_resumes(spark):
    path, manifest = (new_stage_path(spark, f"manifest-{x}") for x in ("landed", "rows"))
    raw = spark.createDataFrame([(1, 5.0, "a"), (1, 2.5, "b"), (2, None, "c"), (2, float("nan"), "d"), (3, 7.0, "e")], "part long, PatID double, s string")
    assert land_new_parts(raw.where("part = 1"), "t", path, manifest).count() == 1
    # A cut run: files of part 2 are there, its row is not.
    spark.createDataFrame([(2, 99, "left over")], "part long, PatID long, s string").write.mode("append").partitionBy("part").parquet(path)
    assert rows(read_landed(spark, path, manifest, "t").select("part", "PatID")) == [(1, 2), (1, 5)]
    assert [r.part for r in land_new_parts(raw, "t", path, manifest).orderBy("part").collect()] == [2, 3]
    assert land_new_parts(raw, "t", path, manifest).count() == 0
    got = read_landed(spark, path, manifest, "t").select("part", "PatID", "s").collect()
    assert sorted(map(str, got)) == sorted(map(str, [r for r in got if r.s in "abcde"])) and len(got) == 5
    assert rows(losses(spark, manifest)) == [("t", 1, "PatID", 2, 0, 0, 1), ("t", 2, "PatID", 2, 1, 1, 0), ("t", 3, "PatID", 1, 0, 0, 0)]
    assert {r.schema for r in read_manifest(spark, manifest).collect()} == {"PatID bigint, s string"}
    with pytest.raises(SchemaChanged):
        land_new_parts(raw.withColumn("new", F.lit(1)), "t", path, manifest)


@pytest.mark.parametrize("block_keys", [1, 5, 256])
def test_compact_key_map_rewrites_alike(spark, owner, block_keys):
    km = key_map(rebase_ids(owner, "PatID"), "PatID")
    child = spark.range(0, 200).select((F.col("id") % 5 + 1).alias("part"), F.when(F.col("id") % 9 > 0, F.col("id") % 70 - 3).alias("PatID"), F.col("id").alias("w"))
    packed = compact_key_map(km, "PatID", block_keys=block_keys)
    for how in ("inner", "left"):
        want = rewrite_fk(child, km, "PatID", how=how)
        got = packed.rewrite(child, how)
        assert got.columns == want.columns and rows(got.fillna(-1)) == rows(want.fillna(-1))
        assert rows(packed.rewrite(child, how, max_bytes=0).fillna(-1)) == rows(want.fillna(-1))


def test_compact_key_map_takes_few_bytes_and_gaps(spark):
    from partweave.operators.broadcast import row_bytes

    n = 50_000
    km = spark.range(0, n).select(F.lit(1).cast("long").alias("part"), (F.col("id") * 3 - 10**6).alias("OrigPatID"), (F.col("id") * 10**9).alias("PatID"))
    packed = compact_key_map(km, "PatID")
    child = km.select("part", F.col("OrigPatID").alias("PatID"), F.col("PatID").alias("want"))
    assert packed.rewrite(child).where("PatID <> want").count() == 0 and packed.rewrite(child).count() == n
    dense = compact_key_map(km.select("part", "OrigPatID", (F.col("PatID") / 10**9).cast("long").alias("PatID")), "PatID")
    assert dense.keys == n and 5 * dense.size < n * row_bytes(km.schema) and dense.size < packed.size < n * row_bytes(km.schema)


def test_key_filter_loses_no_owned_row(spark):
    km = spark.range(0, 3000).select((F.col("id") % 3).alias("part"), F.col("id").alias("OrigPatID"), F.col("id").alias("PatID"))
    child = spark.range(0, 12_000).select((F.col("id") % 3).alias("part"), F.col("id").alias("PatID"), (F.col("id") * 2).alias("w"))
    left = key_filter(km, "PatID", 3000).of(child, "PatID")
    assert left.columns == child.columns
    ids = {r.PatID for r in left.collect()}
    assert set(range(3000)) <= ids and len(ids) < 3000 + 9000 / 6
    want = rewrite_fk(child, km, "PatID")
    assert rows(rewrite_fk(child, km, "PatID", broadcast="never", prefilter=True)) == rows(want)
    plan = rewrite_fk(child, km, "PatID", broadcast="never", prefilter=True)._jdf.queryExecution().toString()
    assert "_pw_bits" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize(
    "values", [range(1, 40_001), [1, 2, 2, 4], [5, 10**15, -(2**40)], [None, 3], [], [-1, -2, -40_000, 7], [0, 32_767, 32_768, -32_768, -32_769]]
)
def test_check_ids_by_bitmaps(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    plain = check_ids(df, "x", bitmaps=False).first()
    assert check_ids(df, "x").first() == plain
    if len(values) < 5 or max(values) < 10**6:
        assert check_ids(df, "x", bitmaps=True).first() == plain


def test_check_ids_sends_no_ids(spark):
    plan = check_ids(spark.range(1, 1000).withColumnRenamed("id", "x"), "x")._jdf.queryExecution().toString()
    assert "bitmap_construct_agg" in plan and "Expand" not in plan
