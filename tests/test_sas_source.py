import pytest

from partweave.sources.parts import land
from partweave.sources.sas import register


def test_parts_read_in_parallel_with_part_from_name(spark, tmp_path):
    from tests.xport_writer import write_xport

    cols = [("PatID", "num", 8), ("PX", "char", 6), ("EncId", "num", 8)]
    for i, n in ((1, 3), (2, 2), (12, 4)):
        write_xport(str(tmp_path / f"procedure_{i}.xpt"), "PROC", cols, [(float(k + 1), f"p{i}{k}", k + 0.5) for k in range(n)])
    (tmp_path / "procedure_x.xpt").write_text("junk")
    register(spark)
    df = (
        spark.read.format("sasparts")
        .option("path", str(tmp_path))
        .option("table", "procedure")
        .option("format", "xport")
        .option("encoding", "ascii")
        .option("chunk_rows", "2")
        .load()
    )
    assert df.rdd.getNumPartitions() == 3
    assert [f.name for f in df.schema.fields] == ["PatID", "PX", "EncId", "part"]
    out = land(df)
    assert dict(out.dtypes) == {"PatID": "bigint", "PX": "string", "EncId": "bigint", "part": "bigint"}
    counts = {r.part: r["count"] for r in out.groupBy("part").count().collect()}
    assert counts == {1: 3, 2: 2, 12: 4}
    assert out.where("part = 12 AND PX = 'p123'").first().EncId == 3


def test_missing_parts_fail(spark, tmp_path):
    register(spark)
    with pytest.raises(Exception):
        spark.read.format("sasparts").option("path", str(tmp_path)).option("table", "death").load().count()


def test_real_xport_parts_through_the_sas_decoder(spark, tmp_path):
    """Genuine SAS transport files, decoded by pandas.read_sas inside the
    Data Source's tasks: float IDs land as bigint, text as string."""
    from tests.xport_writer import write_xport

    cols = [("PatID", "num", 8), ("EncId", "num", 8), ("PX", "char", 6), ("Score", "num", 8)]
    parts = {
        1: [(1.0, 10.0, "A01", 0.5), (2.0, 11.0, "B02", -1.25), (3.0, 12.0, "C3", None)],
        2: [(1.0, 10.0, "A01", 100.0)],
        12: [(7.0, 70.0, "Z", 3.0), (8.0, 80.0, "", 0.0)],
    }
    for i, rows in parts.items():
        write_xport(str(tmp_path / f"procedure_{i}.xpt"), "PROC", cols, rows)
    register(spark)
    df = (
        spark.read.format("sasparts")
        .option("path", str(tmp_path))
        .option("table", "procedure")
        .option("format", "xport")
        .option("encoding", "ascii")
        .option("chunk_rows", "2")
        .load()
    )
    out = land(df)
    assert dict(out.dtypes) == {"PatID": "bigint", "EncId": "bigint", "PX": "string", "Score": "double", "part": "bigint"}
    got = sorted((r.part, r.PatID, r.EncId, r.PX, r.Score) for r in out.collect())
    assert got == [
        (1, 1, 10, "A01", 0.5),
        (1, 2, 11, "B02", -1.25),
        (1, 3, 12, "C3", None),
        (2, 1, 10, "A01", 100.0),
        (12, 7, 70, "Z", 3.0),
        (12, 8, 80, "", 0.0),
    ]


def test_xport_text_without_encoding_is_decoded(spark, tmp_path):
    from tests.xport_writer import write_xport

    write_xport(str(tmp_path / "death_1.xpt"), "DEATH", [("PatID", "num", 8), ("Src", "char", 4)], [(1.0, "ab"), (2.0, None)])
    register(spark)
    df = spark.read.format("sasparts").option("path", str(tmp_path)).option("table", "death").option("format", "xport").load()
    got = sorted((r.PatID, r.Src) for r in land(df).collect())
    assert got == [(1, "ab"), (2, "")]
