"""Key maps in a few bytes a key, and a filter for those that stay too large.

A key map row costs some 40 bytes in a broadcast. ``compact_key_map`` puts the keys of a
part into blocks of neighbouring old IDs: a row holds the old IDs in order, as small offsets.
After a rebase the new IDs of a block are consecutive and need no array: 4 to 5 bytes a key; else they
stand beside the old ones, at 8 to 9. A child finds its block by an equi-join and its key by its place in the block.

``key_filter`` keeps less: a bit for the hash of each key, in bitmaps. A child row whose bit
is not set has no owner and need not be shuffled; some orphans pass, no owned row is lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .broadcast import DEFAULT_MAX_BYTES
from .ids import orig_name
from ..session import stage

BLOCK_KEYS = 256
BITMAP_BITS = 32_768  # fixed value of Spark's bitmap functions
_BLOCK, _BASE, _OLD, _NEW = "_pw_block", "_pw_base", "_pw_old", "_pw_new"


class CompactKeyMap:
    """``blocks(part, block, base, old, new)`` with ``width`` old IDs to a block, and its measured size."""

    def __init__(self, blocks: DataFrame, id_col: str, width: int, keys: int, size: int, part: str):
        self.blocks, self.id_col, self.width, self.keys, self.size, self.part = blocks, id_col, width, keys, size, part

    def rewrite(self, child: DataFrame, how: str = "inner", max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
        """``keys.rewrite_fk`` by this map: broadcast while its measured size is within ``max_bytes``."""
        orig = orig_name(self.id_col)
        c = child.withColumnRenamed(self.id_col, orig)
        side = F.broadcast(self.blocks) if self.size <= max_bytes else self.blocks
        block = F.floor(F.col(orig) / F.lit(self.width))
        met = c.withColumn(_BLOCK, block).join(side, [self.part, _BLOCK], "left")
        low = (F.col(orig) - F.col(_BLOCK) * F.lit(self.width)).cast("int")
        place = F.array_position(_OLD, low)
        behind = F.coalesce(F.element_at(_NEW, F.nullif(place, F.lit(0)).cast("int")), place - 1)
        new = F.when(place > 0, F.col(_BASE) + behind)
        out = met.withColumn(self.id_col, new.cast("long"))
        if how == "inner":
            out = out.where(F.col(self.id_col).isNotNull())
        elif how != "left":
            raise ValueError("how must be 'inner' or 'left'")
        return out.select(self.id_col, *(x for x in c.columns if x != orig))


def compact_key_map(keymap: DataFrame, id_col: str, part: str = "part", block_keys: int = BLOCK_KEYS) -> CompactKeyMap:
    """Packs ``keymap(part, Orig<id>, <id>)``, whose keys are whole and unique inside a part; NULL keys match nothing and are left out.

    A block covers as many old IDs as hold ``block_keys`` keys on average. Where IDs crowd together its
    arrays are longer, and slower to search; they are never cut."""
    orig = orig_name(id_col)
    set_ = keymap.where(F.col(orig).isNotNull() & F.col(id_col).isNotNull())
    spans = set_.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min(orig).alias("lo"), F.max(orig).alias("hi"))
    found = spans.agg(F.sum("n"), F.sum((F.col("hi") - F.col("lo") + 1).cast("double"))).first()
    keys = found[0] or 0
    width = min(2**31 - 1, max(1, int((found[1] or 1) / max(keys, 1) * block_keys)))
    block = F.floor(F.col(orig) / F.lit(width))
    low = (F.col(orig) - block * F.lit(width)).cast("int")
    rows = set_.groupBy(part, block.alias(_BLOCK)).agg(
        F.min(id_col).alias(_BASE),
        F.array_sort(F.collect_list(F.struct(low.alias("old"), F.col(id_col).cast("long").alias("new")))).alias("_keys"),
    )
    delta = F.transform("_keys", lambda k: k["new"] - F.col(_BASE))
    far = (set_.agg(F.max(id_col) - F.min(id_col)).first()[0] or 0) >= 2**31
    rows = rows.withColumn("_delta", delta if far else F.transform(delta, lambda x: x.cast("int")))
    in_turn = F.forall(F.arrays_zip("_delta", F.sequence(F.lit(0), F.size("_delta") - 1).alias("_i")), lambda x: x["_delta"] == x["_i"])
    rows = rows.select(part, _BLOCK, _BASE, F.col("_keys.old").alias(_OLD), F.when(~in_turn, F.col("_delta")).alias(_NEW))
    rows = stage(rows, "compact-keys")
    # A block's row: five fields, two array headers with null bits, and the offsets.
    each = F.when(F.col(_NEW).isNull(), 4).otherwise(12 if far else 8)
    bytes_ = F.lit(8 + 5 * 8 + 2 * 16) + F.size(_OLD) * each + 2 * F.ceil(F.size(_OLD) / 64) * 8
    return CompactKeyMap(rows, id_col, width, keys, int(rows.agg(F.sum(bytes_)).first()[0] or 0), part)


class KeyFilter:
    """Bitmaps of key hashes; ``of`` drops rows that have no key in them."""

    def __init__(self, bitmaps: DataFrame, bits: int, part: str):
        self.bitmaps, self.bits, self.part = bitmaps, bits, part

    def of(self, child: DataFrame, column: str) -> DataFrame:
        place = _hash_place(self.part, column, self.bits)
        at, bit = "_pw_bucket", "_pw_bit"
        rows = child.where(F.col(column).isNotNull()).withColumn(at, F.floor(place / F.lit(BITMAP_BITS))).withColumn(bit, F.pmod(place, F.lit(BITMAP_BITS)).cast("int"))
        met = rows.join(F.broadcast(self.bitmaps), at)
        byte = F.conv(F.hex(F.substring(F.col("_pw_bits"), F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return met.where(F.call_function("shiftright", byte, F.col(bit) % 8).bitwiseAND(1) == 1).select(*child.columns)


def _hash_place(part: str, column: str, bits: int):
    return F.pmod(F.xxhash64(F.col(part).cast("long"), F.col(column).cast("long")), F.lit(bits))


def key_filter(keymap: DataFrame, id_col: str, keys: int, part: str = "part", max_bytes: int = DEFAULT_MAX_BYTES) -> KeyFilter:
    """A filter for the old IDs of ``keymap`` in at most ``max_bytes``: eight bits a key if they fit
    (an orphan passes one time in eight), fewer for a larger map. ``keys``: its rows."""
    orig = orig_name(id_col)
    wanted = min(8 * max(keys, 1), 8 * max_bytes)
    bits = BITMAP_BITS * -(-wanted // BITMAP_BITS)
    place = _hash_place(part, orig, bits)
    set_ = keymap.where(F.col(orig).isNotNull())
    rows = set_.groupBy(F.floor(place / F.lit(BITMAP_BITS)).alias("_pw_bucket")).agg(
        F.bitmap_construct_agg(F.pmod(place, F.lit(BITMAP_BITS))).alias("_pw_bits")
    )
    return KeyFilter(stage(rows, "key-filter"), bits, part)
