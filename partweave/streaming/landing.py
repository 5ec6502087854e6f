"""Landing parts as they arrive.

Extracts come one numbered file at a time. ``land_stream`` watches a folder
of ``<table>-<i>-snappy.parquet`` files with Structured Streaming, takes the
part number from each file name, casts ``*id`` columns to bigint and appends
to a ``part=NN/`` partitioned table. The file sink plus a checkpoint make the
landing exactly-once and restartable after a lost executor or driver.

``part_row_counts`` is the running row count per part (streaming state),
the input of the part offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.columns import cast_ids_by_suffix
from ..session import new_stage_path
from ..sources.parts import PART_FILE_PATTERN, part_from_file_name


def read_part_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    pattern: str = PART_FILE_PATTERN,
    max_files_per_trigger: int | None = None,
    layout: str = "flat",
) -> DataFrame:
    """Streaming DataFrame of every part file landing in ``source_dir``,
    with its ``part`` column. File sources need a declared schema.

    ``layout='flat'``: ``<table>-<i>-snappy.parquet`` files, part from the
    name; a file with another name fails the query, as it fails the batch reader. ``'partitioned'``: ``part=NN/`` folders, found by the source's
    partition discovery (``part`` is added to the schema)."""
    if layout == "partitioned" and "part" not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField("part", T.LongType(), True)])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.parquet(source_dir)
    if layout == "flat":
        number = part_from_file_name(pattern)
        stray = F.raise_error(F.concat(F.lit("not named as a part: "), F.col("_metadata.file_path"))).cast("long")
        return df.withColumn("part", F.coalesce(number, stray))
    if layout == "partitioned":
        return df
    raise ValueError("layout must be 'flat' or 'partitioned'")


def land_stream(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    schema: T.StructType,
    checkpoint: str | None = None,
    id_suffix: str = "id",
    pattern: str = PART_FILE_PATTERN,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    layout: str = "flat",
    exclude: tuple[str, ...] = (),
) -> StreamingQuery:
    """Start the landing query; ``exclude``: columns with the ID suffix that are no IDs. ``available_now`` lands what is there and stops
    (a scheduled batch); otherwise it keeps watching. The checkpoint defaults
    to a fresh folder under ``spark.checkpoint.dir``."""
    src = read_part_stream(spark, source_dir, schema, pattern, max_files_per_trigger, layout)
    landed = cast_ids_by_suffix(src, id_suffix, exclude)
    w = (
        landed.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint or new_stage_path(spark, "land-stream-ckpt"))
        .partitionBy("part")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def part_row_counts(parts: DataFrame, part: str = "part") -> DataFrame:
    """Running rows per part over a stream of part rows (complete/update
    output mode); one state entry per part."""
    return parts.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))
