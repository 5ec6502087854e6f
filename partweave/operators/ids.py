"""Owner IDs: part offsets, dense rebase, key maps and the ID check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType
from pyspark.sql.window import Window as W

from .broadcast import DEFAULT_MAX_BYTES, checked_broadcast, max_rows_for
from ..session import stage
from .numbering import DuplicateKeys, number_rows, sort_keys
from .segments import whole


_ROW_HASH = "_pw_row_hash"
_ROW_ID = "_pw_row_id"
# Owners with more columns than this besides part and id are numbered
# through their keys only (see assign_ids).
KEYS_ONLY_MIN_EXTRA_COLUMNS = 4


def orig_name(id_col: str) -> str:
    """Name the old ID keeps after a rebase (``PatID`` -> ``OrigPatID``)."""
    return "Orig" + id_col


def part_counts(df: DataFrame, part: str = "part") -> DataFrame:
    """Rows per part: (part, n_rows)."""
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))


def part_offsets(df: DataFrame, part: str = "part") -> DataFrame:
    """(part, n_rows, start_id): the first new ID of each part is 1 + the rows
    of all earlier parts. The window runs over one row per part."""
    return offsets_of(part_counts(df, part), part)


def offsets_of(counts: DataFrame, part: str = "part") -> DataFrame:
    """``part_offsets`` from ``part_counts``."""
    before = W.orderBy(F.col(part).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn(
        "start_id", (F.lit(1) + F.coalesce(F.sum("n_rows").over(before), F.lit(0))).cast("long")
    )


def fan_out(owner: DataFrame, id_col: str, part: str = "part") -> DataFrame:
    """Owner keys that occur more than once inside one part: (part, id, n)."""
    return (
        owner.groupBy(part, id_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


class DuplicateOwnerKeys(DuplicateKeys):
    pass


def assign_ids(
    df: DataFrame,
    id_col: str,
    part: str = "part",
    method: str = "two_pass",
    on_duplicates: str = "fail",
    num_partitions: int | None = None,
    stats: dict | None = None,
    max_group_rows: int = 1_000_000,
    broadcast_max_bytes: int = DEFAULT_MAX_BYTES,
    keys_only: bool | None = None,
    keys_only_above: int = KEYS_ONLY_MIN_EXTRA_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """``(rebased owner, key map)``; see ``rebase_ids``.

    ``keys_only``: with unique keys (``on_duplicates='fail'``) the two-pass
    method can number only the narrow (part, id) key table - the range
    partitioner's sampling scan and the staged copy are two columns wide, not
    the whole owner - and join the new ID back (null-safe, so a NULL old ID
    keeps its row; broadcast when the exact row count proves the key map
    small). The key map for children is then that narrow staged table.
    It pays off for wide owners; for an owner with few columns the join-back
    costs more than it saves, so the default (None) uses it only when the
    owner has more than ``keys_only_above`` columns besides part and id.
    """
    orig = orig_name(id_col)
    if on_duplicates not in ("fail", "keep"):
        raise ValueError("on_duplicates must be 'fail' or 'keep'")
    if keys_only is None:
        keys_only = len(df.columns) - 2 > keys_only_above
    if method == "two_pass" and on_duplicates == "fail" and keys_only:
        renamed = df.withColumnRenamed(id_col, orig)
        st: dict = {}
        try:
            km = number_rows(
                renamed.select(part, orig), [part, orig], id_col, num_partitions=num_partitions, on_ties="fail", stats=st
            )
        except DuplicateKeys as e:
            raise DuplicateOwnerKeys(f"{id_col} repeats inside a part; see fan_out(): {e}") from e
        if stats is not None:
            stats.update(st)
        side = F.broadcast(km) if st["rows"] <= max_rows_for(km, broadcast_max_bytes) else km
        r, k = renamed.alias("r"), side.alias("k")
        cond = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (part, orig)]
        out = r.join(k, cond, "inner").select(*[F.col(f"r.{c}") for c in renamed.columns], F.col(f"k.{id_col}"))
        return out, km
    rb = _rebase_full_rows(df, id_col, part, method, on_duplicates, num_partitions, stats, max_group_rows)
    return rb, key_map(rb, id_col, part)


def assign_ids_many(
    owners: dict[str, tuple[DataFrame, str]],
    part: str = "part",
    num_partitions: int | None = None,
    broadcast_max_bytes: int = DEFAULT_MAX_BYTES,
) -> dict[str, tuple[DataFrame, DataFrame, int]]:
    """Rebase several owners with one distributed numbering: their narrow
    (owner, part, id) keys are unioned and numbered once with
    ``restart_by=[owner]`` - one sampling pass, one range shuffle, one staged
    write for all of them, balanced across owners by the range partitioner.
    Each owner's IDs still start at 1 in its own (part, id) order. Returns
    ``{owner: (rebased, key map, rows)}``. Owner keys must be unique (the
    check rides along, per owner) and share one type.
    """
    tag = "_pw_owner"
    orig = "_pw_orig"
    keys = [
        df.select(F.lit(name).alias(tag), F.col(part), F.col(id_col).alias(orig))
        for name, (df, id_col) in owners.items()
    ]
    union = reduce(DataFrame.unionByName, keys)
    stats: dict = {}
    try:
        numbered = number_rows(
            union, [part, orig], "_pw_new", restart_by=[tag], num_partitions=num_partitions, on_ties="fail", stats=stats
        )
    except DuplicateKeys as e:
        raise DuplicateOwnerKeys(f"owner IDs repeat inside a part; see fan_out(): {e}") from e
    sizes = {r[tag]: r["n"] for r in numbered.groupBy(tag).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row an owner
    out = {}
    for name, (df, id_col) in owners.items():
        o = orig_name(id_col)
        km = numbered.where(F.col(tag) == name).select(part, F.col(orig).alias(o), F.col("_pw_new").alias(id_col))
        rows = sizes.get(name, 0)
        side = F.broadcast(km) if rows <= max_rows_for(km, broadcast_max_bytes) else km
        renamed = df.withColumnRenamed(id_col, o)
        r, k = renamed.alias("r"), side.alias("k")
        cond = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (part, o)]
        rebased = r.join(k, cond, "inner").select(*[F.col(f"r.{c}") for c in renamed.columns], F.col(f"k.{id_col}"))
        out[name] = (rebased, km, rows)
    return out


def rebase_ids(
    df: DataFrame,
    id_col: str,
    part: str = "part",
    method: str = "two_pass",
    on_duplicates: str = "fail",
    num_partitions: int | None = None,
    stats: dict | None = None,
    max_group_rows: int = 1_000_000,
) -> DataFrame:
    """Keep the old ID as ``Orig<id_col>`` (in place) and append a new dense
    ``id_col`` (bigint) numbered 1.. over all parts in (part, old id) order.
    Part ``i`` therefore starts at 1 + the rows of parts before it.

    ``on_duplicates='fail'`` refuses an owner with a repeated (part, id) - each
    copy would get its own ID and multiply its children. ``'keep'`` numbers every
    copy, as a plain sequence would. With the two-pass method the check costs
    no extra shuffle; ``stats`` then receives the owner's row count.

    ``method='window'`` numbers each part with ``row_number()`` (one task per
    part, no staging) - only while every part has at most ``max_group_rows``
    rows; a bigger part switches the call to the exact two-pass method.

    ``method='segments'`` cuts each part by an exact histogram of its IDs and numbers the
    pieces: no staged copy, any part size. For a result that is read once.
    """
    return assign_ids(df, id_col, part, method, on_duplicates, num_partitions, stats, max_group_rows)[0]


def _rebase_full_rows(df, id_col, part, method, on_duplicates, num_partitions, stats, max_group_rows):
    orig = orig_name(id_col)
    renamed = df.withColumnRenamed(id_col, orig)
    order = [orig]
    if on_duplicates == "keep":
        # Repeated keys, by either method: the tie is broken by a hash of the
        # whole row, so a re-run gives every distinct copy the same ID again;
        # then by a row id, so even a hot group of identical rows can be split
        # across range partitions (identical rows are interchangeable). The row
        # id is written with the rows: a re-run task cannot change it.
        order += [_ROW_HASH, _ROW_ID]
        keyed = renamed.withColumn(_ROW_HASH, F.xxhash64(*renamed.columns))
        renamed = stage(keyed.withColumn(_ROW_ID, F.monotonically_increasing_id()), "rebase-rows")
    if method == "window":
        counts = stage(part_counts(df, part), "part-counts")  # a row a part: for the guard, the offsets and the total
        if not counts.where(F.col("n_rows") > max_group_rows).isEmpty():
            method = "two_pass"
    elif method not in ("two_pass", "segments"):
        raise ValueError(f"unknown method {method!r}")
    if method == "segments" and not (on_duplicates == "fail" and whole(df.schema[id_col].dataType)):
        method = "two_pass"  # the histogram needs whole, unique keys; the numbers are the same
    if method == "segments":
        try:
            return number_rows(renamed, [part, orig], id_col, method=method, on_ties="fail", stats=stats)
        except DuplicateKeys as e:
            raise DuplicateOwnerKeys(f"{id_col} repeats inside a part; see fan_out(): {e}") from e
    if method == "two_pass":
        ties = "fail" if on_duplicates == "fail" else "ignore"
        try:
            out = number_rows(renamed, [part, *order], id_col, num_partitions=num_partitions, on_ties=ties, stats=stats)
        except DuplicateKeys as e:
            raise DuplicateOwnerKeys(f"{id_col} repeats inside a part; see fan_out(): {e}") from e
        return out.drop(_ROW_HASH, _ROW_ID)
    if on_duplicates == "fail" and not fan_out(df, id_col, part).isEmpty():
        raise DuplicateOwnerKeys(f"{id_col} repeats inside a part; see fan_out()")
    offs = offsets_of(counts, part)
    if stats is not None:
        stats["rows"] = counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    local = number_rows(renamed, order, "_pw_rn", restart_by=[part], method="window")
    # One row per part.
    j = local.alias("l").join(checked_broadcast(offs).alias("o"), F.col(f"l.{part}").eqNullSafe(F.col(f"o.{part}")))
    return j.select(
        *[F.col(f"l.{c}") for c in renamed.columns if c not in (_ROW_HASH, _ROW_ID)],
        (F.col("o.start_id") + F.col("l._pw_rn") - 1).cast("long").alias(id_col),
    )


def key_map(rebased: DataFrame, id_col: str, part: str = "part") -> DataFrame:
    """(part, Orig<id>, <id>): the old-to-new pairs of an owner."""
    return rebased.select(part, orig_name(id_col), id_col)


# Bitmaps hold this many neighbouring IDs each (fixed value of Spark's bitmap functions), and
# pay while at least one in so many of the IDs between the least and the greatest is there.
BITMAP_IDS = 32_768
LEAST_SHARE = 256


def check_ids(df: DataFrame, id_col: str, bitmaps: bool | None = None) -> DataFrame:
    """One row: n_rows, n_distinct, min_id, max_id, n_null, is_dense
    (unique, no NULL, exactly 1..n_rows).

    ``bitmaps``: distinct IDs are counted as the bits of one bitmap for each stretch of
    ``BITMAP_IDS`` of them, made before the shuffle: a task sends 4 KB a stretch, and no ID.
    That is for whole IDs without wide gaps, as after a rebase; the default (None) looks at
    their extremes and number first. Else IDs are counted by a distinct aggregation."""
    c = F.col(id_col)
    n = F.count(F.lit(1))
    if bitmaps is None:
        bitmaps = whole(df.schema[id_col].dataType) and not isinstance(df.schema[id_col].dataType, DateType)
        if bitmaps:
            low, high, rows = df.agg(F.min(c), F.max(c), F.count(c)).first()
            bitmaps = rows > 0 and high - low < LEAST_SHARE * rows
    if not bitmaps:
        nd = F.count_distinct(c)
        found = df.agg(n.alias("n_rows"), nd.alias("n_distinct"), F.min(c).alias("min_id"), F.max(c).alias("max_id"), F.count(c).alias("_set"))
    else:
        v = c.cast("long")
        stretch = df.groupBy(F.floor(v / F.lit(BITMAP_IDS)).alias("_stretch")).agg(
            n.alias("_n"),
            F.count(c).alias("_set"),
            F.bitmap_construct_agg(F.pmod(v, F.lit(BITMAP_IDS))).alias("_bits"),
            F.min(c).alias("_min"),
            F.max(c).alias("_max"),
        )
        found = stretch.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("_set") > 0, F.bitmap_count("_bits")).otherwise(0)), F.lit(0)).alias("n_distinct"),
            F.min("_min").alias("min_id"),
            F.max("_max").alias("max_id"),
            F.coalesce(F.sum("_set"), F.lit(0)).alias("_set"),
        )
    rows, distinct = F.col("n_rows"), F.col("n_distinct")
    return found.select(
        "n_rows", "n_distinct", "min_id", "max_id", (rows - F.col("_set")).alias("n_null"),
        ((rows == distinct) & (F.col("min_id") == 1) & (F.col("max_id") == rows)).alias("is_dense"),
    )


__all__ = [
    "DuplicateOwnerKeys",
    "assign_ids",
    "assign_ids_many",
    "check_ids",
    "fan_out",
    "key_map",
    "orig_name",
    "part_counts",
    "part_offsets",
    "rebase_ids",
    "sort_keys",
]
