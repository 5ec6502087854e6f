"""Dense numbers without a staged copy of the table.

A histogram of the last ordering key (a whole number or a date) is made first, in
log-linear buckets: the twelve leading bits of a value name its bucket, so there are at
most a few hundred thousand of them for each group of the other keys, whatever
the values, and a bucket of an even range holds a few ten-thousandths of it.
Buckets with too many rows are cut again by the distance from their least value.
Counts are exact and add up across tasks, so the running sums over the buckets
are the numbers at which they start. Neighbouring buckets make a segment of about the
wanted rows; ``row_number()`` inside it, added to its start, is the answer.

The histogram is written once and small. It alone decides where segments are cut: a
task that runs again cuts alike, and the rows are shuffled once and written never."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..session import stage
from .broadcast import DEFAULT_MAX_BYTES, is_at_most, row_bytes

LEADING_BITS = 12
MOST_SEGMENT_ROWS = 1_000_000
_KEY, _SEG, _START = "_pw_key", "_pw_seg", "_pw_start"


def whole(kind: T.DataType) -> bool:
    """Whether values of this type can be put into buckets."""
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType))


def bucket(value: Column) -> Column:
    """A long with all but its leading bits cleared; in the order of the values, NULL for NULL."""
    size = F.when(value < 0, F.bitwise_not(value)).otherwise(value)
    drop = F.greatest(F.length(F.bin(size)) - LEADING_BITS, F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)
    return F.when(value < 0, F.bitwise_not(low)).otherwise(low)


def _same(left: str, right: str, names: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]


def _small(df: DataFrame) -> DataFrame:
    """A broadcast if the rows (numbers and dates) surely fit, else ``df`` for a shuffle join."""
    return F.broadcast(df) if is_at_most(df, DEFAULT_MAX_BYTES // (2 * row_bytes(df.schema))) else df


def number_by_segments(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    restart_by: Sequence[str] = (),
    segment_rows: int | None = None,
) -> tuple[DataFrame, int]:
    """``df`` with ``name``, and its rows; see ``numbering.number_rows``. The last of ``order_by`` must be
    whole (see ``whole``); the others, and ``restart_by``, make groups whose number should be small
    beside the rows. Rows that agree in all keys are numbered in any order."""
    *head, tail = order_by
    groups = [*restart_by, *head]
    spark = df.sparkSession
    kind = df.schema[tail].dataType
    value = F.unix_date(tail) if isinstance(kind, T.DateType) else F.col(tail)
    paths = ["_pw_b0"]
    keys = df.select(*groups, value.cast("long").alias(_KEY)).withColumn(paths[0], bucket(F.col(_KEY)))
    counted = [F.count(F.lit(1)).alias("_n"), F.min(_KEY).alias("_lo"), F.max(_KEY).alias("_hi")]
    levels = [stage(keys.groupBy(*groups, *paths).agg(*counted), "segments-histogram")]
    total, most = levels[0].agg(F.sum("_n"), F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n")))).first()
    total = int(total or 0)
    if segment_rows is None:
        wanted = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        segment_rows = max(1, min(MOST_SEGMENT_ROWS, -(-total // wanted)))
    crowded = (F.col("_n") > segment_rows) & (F.col("_lo") < F.col("_hi"))

    def deeper(rows: DataFrame, level: int) -> DataFrame:
        """``rows`` with their bucket one level down, where the one above is crowded, else NULL."""
        above = levels[level - 1].where(crowded).select(*groups, *paths[:level], F.col("_lo").alias("_from"))
        r, a = rows.alias("r"), _small(above).alias("a")
        met = r.join(a, _same("r", "a", [*groups, *paths[:level]]), "left")
        return met.select("r.*", bucket(F.col(f"r.{_KEY}") - F.col("a._from")).alias(f"_pw_b{level}"))

    while most is not None and most > segment_rows:
        keys = deeper(keys, len(levels))
        paths.append(f"_pw_b{len(levels)}")
        levels.append(stage(keys.where(F.col(paths[-1]).isNotNull()).groupBy(*groups, *paths).agg(*counted), "segments-histogram"))
        most = levels[-1].agg(F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n")))).first()[0]

    leaves = None
    for i, level in enumerate(levels):
        own = level.where(~crowded | F.col("_lo").isNull()) if i + 1 < len(levels) else level
        own = own.select(*groups, *paths[: i + 1], *(F.lit(None).cast("long").alias(p) for p in paths[i + 1 :]), "_lo", "_n")
        leaves = own if leaves is None else leaves.unionByName(own)
    # Rows before a bucket: first inside its group, then before the group, so no window holds more than
    # a group's buckets or all groups.
    last = [F.col("_lo").asc_nulls_last()]
    inside = W.partitionBy(*groups).orderBy(*last).rowsBetween(W.unboundedPreceding, -1) if groups else W.orderBy(*last).rowsBetween(W.unboundedPreceding, -1)
    leaves = leaves.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    if head:
        sizes = levels[0].groupBy(*groups).agg(F.sum("_n").alias("_rows"))
        order = [F.col(c).asc_nulls_last() for c in head]
        earlier = (W.partitionBy(*restart_by) if restart_by else W).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        sizes = sizes.withColumn("_group", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        b, s = leaves.alias("b"), sizes.alias("s")
        leaves = b.join(s, _same("b", "s", groups)).select("b.*", (F.col("b._before") + F.col("s._group")).alias("_from_group")).drop("_before").withColumnRenamed("_from_group", "_before")
    leaves = leaves.withColumn(_SEG, F.floor(F.col("_before") / F.lit(segment_rows)))
    whole_segment = W.partitionBy(*restart_by, _SEG)
    leaves = leaves.select(*groups, *paths, _SEG, F.min("_before").over(whole_segment).alias(_START))
    leaves = _small(stage(leaves, "segments"))

    rows = df.withColumn(_KEY, value.cast("long")).withColumn("_pw_b0", bucket(F.col(_KEY)))
    for level in range(1, len(levels)):
        rows = deeper(rows, level)
    r, s = rows.alias("r"), leaves.alias("s")
    met = r.join(s, _same("r", "s", [*groups, *paths])).select(*(F.col(f"r.{c}") for c in df.columns), f"s.{_SEG}", f"s.{_START}")
    place = W.partitionBy(*restart_by, _SEG).orderBy(*(F.col(c).asc_nulls_last() for c in order_by))
    out = met.withColumn(name, (F.col(_START) + F.row_number().over(place)).cast("long"))
    return out.select(*df.columns, name), total
