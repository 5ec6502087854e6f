"""Foreign-key rewrites: replace a child's old ID by the owner's new one,
always matching inside the same part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .broadcast import DEFAULT_MAX_BYTES, checked_broadcast, hashed, max_rows_for
from ..session import stage
from .compact import key_filter
from .ids import orig_name

JOIN_KINDS = ("inner", "left")


def rewrite_fk(
    child: DataFrame,
    keymap: DataFrame,
    id_col: str,
    part: str = "part",
    how: str = "inner",
    broadcast: str = "auto",
    hot_key_rows: int | None = None,
    keymap_rows: int | None = None,
    broadcast_max_bytes: int = DEFAULT_MAX_BYTES,
    prefilter: bool = False,
) -> DataFrame:
    """Child with ``id_col`` replaced by the new ID from ``keymap``
    (part, Orig<id>, <id>), the new column first and the old one dropped.

    ``how='inner'`` drops rows whose ID is NULL or has no owner in the same
    part (what a plain join does - see ``orphans``); ``'left'`` keeps them with
    a NULL ID.

    Join strategy: ``broadcast='auto'`` broadcasts the key map when its size is
    proven under budget (no shuffle of the child at all); otherwise a shuffle
    join on (part, id) whose hot partitions AQE splits at runtime (a key map of
    known size that is large is hashed, so the child is not sorted). With
    ``hot_key_rows`` set, keys with at least that many child rows are split off
    up front and joined against a broadcast of just their key-map rows, so no
    single key reaches one task. ``keymap_rows``, when the caller knows the
    key map's row count, replaces the size check's counting job.
    ``broadcast_max_bytes`` is the budget for one broadcast key map.

    ``prefilter`` (inner joins, key maps over the budget): most orphans are dropped where the child
    is scanned, by a bitmap filter of the key map's hashes within the budget (``compact.key_filter``),
    so they are never shuffled.
    """
    if how not in JOIN_KINDS:
        raise ValueError(f"how must be one of {JOIN_KINDS}")
    orig = orig_name(id_col)
    c = child.withColumnRenamed(id_col, orig)
    km = keymap.select(part, orig, id_col)
    keys = [part, orig]
    # ``SELECT km.id, child.*`` without the old ID: the new key goes first.
    out_cols = [id_col] + [x for x in c.columns if x != orig]

    side = known_broadcast(km, keymap_rows, broadcast, broadcast_max_bytes)
    if prefilter and how == "inner" and side is km:
        rows = keymap_rows if keymap_rows is not None else km.count()
        c = key_filter(km, id_col, rows, part, broadcast_max_bytes).of(c, orig)
    if hot_key_rows is None or side is not km:
        # A broadcast key map never shuffles the child: no key can be hot.
        side = hashed(km, keymap_rows) if side is km else side
        return c.join(side, keys, how).select(*out_cols)

    counts = c.where(F.col(orig).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most (child rows / hot_key_rows) keys; a hot key is dealt over as many
    # salts as it has times that many rows.
    salts = F.ceil(F.col("_n") / F.lit(hot_key_rows)).cast("int").alias("_salts")
    hot = stage(counts.where(F.col("_n") >= hot_key_rows).select(*keys, salts), "hot-keys")
    hot = checked_broadcast(hot, broadcast_max_bytes)
    # The salt is a function of the row, so a map task that runs again deals it out alike.
    # Rows of a hot key that agree in all columns share a salt; that partition is left to AQE.
    salt = fresh_name([*c.columns, *km.columns], "_salt")
    row = F.pmod(F.xxhash64(*c.columns), F.coalesce("_salts", F.lit(1)))
    dealt = c.join(hot, keys, "left").withColumn(salt, row.cast("int")).drop("_salts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    spread = km.join(hot, keys, "left").withColumn(salt, every).drop("_salts")
    return dealt.join(spread, [*keys, salt], how).select(*out_cols)


def fresh_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (any case)."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def known_broadcast(km: DataFrame, rows: int | None, broadcast: str, max_bytes: int) -> DataFrame:
    """``km`` broadcast if its size is proven under ``max_bytes`` - by the row count its
    maker knows, else by a bounded count - or if asked for; else ``km`` itself."""
    if broadcast not in ("auto", "always", "never"):
        raise ValueError("broadcast must be 'auto', 'always' or 'never'")
    if broadcast == "always":
        return F.broadcast(km)
    if broadcast == "never":
        return km
    if rows is not None and rows <= max_rows_for(km, max_bytes):
        return F.broadcast(km)
    if rows is not None and max_rows_for(km, max_bytes):
        return km
    return checked_broadcast(km, max_bytes)


def orphans(
    child: DataFrame,
    keymap: DataFrame,
    id_col: str,
    part: str = "part",
    keymap_rows: int | None = None,
    broadcast: str = "auto",
    broadcast_max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Child rows an inner rewrite would drop: ID NULL or absent from the
    owner's same part. With ``keymap_rows`` known, the key map is broadcast or
    hashed as ``rewrite_fk`` does."""
    orig = orig_name(id_col)
    km = keymap.select(part, F.col(orig).alias(id_col))
    if keymap_rows is not None:
        side = known_broadcast(km, keymap_rows, broadcast, broadcast_max_bytes)
        km = hashed(km, keymap_rows) if side is km else side
    return child.join(km, [part, id_col], "left_anti")
