"""Dense 1-based row numbers in a total order, computed without sending any
group (or the whole table) to one task.

``two_pass`` (default, any size):
  1. range-partition on the ordering keys (``n`` partitions, at most
     ``spark.sql.shuffle.partitions``, sized by AQE unless given) and sort each
     one; tag every row with its partition id and position inside it;
  2. stage the tagged rows (a written table under ``spark.checkpoint.dir``):
     range bounds are sampled, so a recomputation could cut the data
     differently - after the write the tags are fixed facts;
  3. count rows per segment - per partition, or per (partition, restart key) -
     which is a table of at most ``n`` (+ number of restart keys) rows;
  4. running sums over that small table give every segment's first number,
     which is joined back (broadcast when the table is counted small) and the
     position added.
  A duplicate-key check rides along at no extra shuffle (``on_ties='fail'``).
  A hot part or key range is cut into many partitions by the range
  partitioner, so no task holds more than about ``1/n`` of the rows
  (duplicated ordering keys excepted: equal keys share a partition).

``segments``: for whole-number keys, by an exact histogram of the last one; the
rows are neither staged nor sampled (see ``segments``). Best where the result is
read once; a staged result is cheaper to read again.

``window``: ``row_number()`` over ``partitionBy(restart_by)``. Each restart
group is sorted by one task - fine for small groups and as a test reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import stage, stage_counted
from .segments import number_by_segments, whole

PID = "_pw_pid"
POS = "_pw_pos"
_BASE = "_pw_base"
_TIES = "_pw_ties"

METHODS = ("two_pass", "segments", "window")


def sort_keys(cols: Sequence[str]) -> list[Column]:
    """Ascending, NULLs last (the order the SQL oracle uses)."""
    return [F.col(c).asc_nulls_last() for c in cols]


def _null_last_keys(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """(isnull(c), c) per nullable column, c alone otherwise: ascending
    NULLs-last order spelled in NULLs-first terms, so a window partitioned by
    the same expressions finds its required ordering already in place (no
    second sort). A non-nullable column gets no ``isnull`` companion: Catalyst
    would fold it to a literal, which the window's partitioning drops and the
    range partitioning keeps - a mismatch that costs a whole extra shuffle.
    (A key only the optimizer infers to be non-NULL, e.g. an inner-join key,
    can still cost that shuffle; results are unaffected.)"""
    out: list[Column] = []
    for c in cols:
        if df.schema[c].nullable:
            out.append(F.isnull(c))
        out.append(F.col(c))
    return out


class DuplicateKeys(ValueError):
    """The ordering keys repeat inside a restart group."""


# Segments (one per range partition and restart key) that may be broadcast: 3 MB.
BROADCAST_SEGMENTS = 100_000


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    restart_by: Sequence[str] = (),
    method: str = "two_pass",
    num_partitions: int | None = None,
    on_ties: str = "ignore",
    stats: dict | None = None,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Append ``name`` (bigint): ``row_number() OVER ([PARTITION BY restart_by]
    ORDER BY order_by)``, ascending with NULLs last.

    Keep the keys unique, or ties are numbered in an arbitrary (but, once
    staged, fixed) order; ``on_ties='fail'`` raises ``DuplicateKeys`` instead.
    ``stats``, if given, receives ``rows``: the number of rows numbered (known
    for free from the segment counts).

    ``method='window'`` sorts each restart group in one task. With
    ``max_group_rows`` set (``rebase_ids`` sets it), the group sizes are
    counted first and any group above it sends the whole call to the two-pass
    method - same numbers, no oversized task.
    """
    order_by, restart_by = list(order_by), list(restart_by)
    if on_ties not in ("ignore", "fail"):
        raise ValueError("on_ties must be 'ignore' or 'fail'")
    if method == "window":
        if not restart_by:
            raise ValueError("the window method needs restart_by (a whole-table window is one task)")
        if max_group_rows is not None:
            over = df.groupBy(*restart_by).count().where(F.col("count") > max_group_rows)
            if not over.isEmpty():
                # A group too big for one task: the exact distributed method.
                return _number_two_pass(df, order_by, name, restart_by, num_partitions, on_ties, stats)
        if on_ties == "fail" and df.groupBy(*restart_by, *order_by).count().where("count > 1").limit(1).count():
            raise DuplicateKeys(f"{restart_by + order_by} repeat")
        w = W.partitionBy(*restart_by).orderBy(*sort_keys(order_by))
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    if method == "segments":
        if not whole(df.schema[order_by[-1]].dataType):
            raise ValueError(f"the segments method needs a whole number or date as last key, not {order_by[-1]}")
        if on_ties == "fail" and not df.groupBy(*restart_by, *order_by).count().where("count > 1").isEmpty():
            raise DuplicateKeys(f"{restart_by + order_by} repeat")
        out, rows = number_by_segments(df, order_by, name, restart_by)
        if stats is not None:
            stats["rows"] = rows
        return out
    if method != "two_pass":
        raise ValueError(f"unknown numbering method {method!r}; use one of {METHODS}")
    return _number_two_pass(df, order_by, name, restart_by, num_partitions, on_ties, stats)


def _number_two_pass(df, order_by, name, restart_by, num_partitions, on_ties, stats):
    exprs = _null_last_keys(df, restart_by + order_by)
    keys = [e.asc() for e in exprs]
    pid = F.spark_partition_id()
    # Without an explicit count AQE sizes the range partitions from measured
    # bytes (coalescing keeps contiguous ranges, so the global order holds);
    # there are at most spark.sql.shuffle.partitions of them either way.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    tagged = (
        ranged
        .sortWithinPartitions(*keys)
        .withColumn(PID, pid)
        # monotonically_increasing_id = partition id << 33 | row index in partition
        .withColumn(POS, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )
    if on_ties == "fail":
        # Equal keys share a range partition, and range partitioning on the
        # keys already clusters them: this window adds no shuffle.
        tagged = tagged.withColumn(_TIES, F.count(F.lit(1)).over(W.partitionBy(*exprs)))
    staged = stage(tagged, "numbering")

    seg_keys = [PID, *restart_by]
    aggs = [F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first")]
    if on_ties == "fail":
        aggs.append(F.max(_TIES).alias("_ties"))
    counts = staged.groupBy(*seg_keys).agg(*aggs)
    ties = ["_ties"] if on_ties == "fail" else []
    if restart_by:
        seg_df, rows, most = _segments_by_group(counts, seg_keys, restart_by, ties)
    else:
        seg_df, rows, most = _segments_in_order(df.sparkSession, counts, ties)
    if most > 1:
        bad = counts.where("_ties > 1").select(*restart_by).distinct().limit(5).collect() if restart_by else []
        where = f" in groups such as {[tuple(r) for r in bad]}" if bad else ""
        raise DuplicateKeys(f"{restart_by + order_by} repeat (up to {most} rows per key){where}")
    if stats is not None:
        stats["rows"] = rows

    s, g = staged.alias("s"), seg_df.alias("g")
    cond = [F.col(f"s.{PID}") == F.col(f"g.{PID}")] + [F.col(f"s.{k}").eqNullSafe(F.col(f"g.{k}")) for k in restart_by]
    out = s.join(g, cond, "inner")
    return out.select(*[F.col(f"s.{c}") for c in df.columns], (F.col(f"g.{_BASE}") + F.col(f"s.{POS}") + 1).alias(name))


def _segments_in_order(spark, counts, ties):
    """One row a range partition - at most ``spark.sql.shuffle.partitions`` - summed up on the driver."""
    before, rows, most = 0, [], 0
    for r in counts.orderBy(PID).collect():
        rows.append((r[PID], before - r["_first"]))
        before += r["_n"]
        most = max(most, r["_ties"] if ties else 0)
    return F.broadcast(spark.createDataFrame(rows, f"{PID} int, {_BASE} long")), before, most


def _segments_by_group(counts, seg_keys, restart_by, ties):
    """One row a segment: at most n + groups - 1. Running sums over them inside each
    restart group: a group's segments are at most n rows."""
    before = W.partitionBy(*restart_by).orderBy(PID).rowsBetween(W.unboundedPreceding, -1)
    base = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias(_BASE)
    seg, n_segments = stage_counted(counts.select(*seg_keys, base, "_n", *ties), "numbering-segments")
    summary = seg.agg(F.sum("_n"), *[F.max(t) for t in ties]).first()
    seg_df = seg.select(*seg_keys, _BASE)
    seg_df = F.broadcast(seg_df) if n_segments <= BROADCAST_SEGMENTS else seg_df
    return seg_df, summary[0] or 0, (summary[1] or 0) if ties else 0
