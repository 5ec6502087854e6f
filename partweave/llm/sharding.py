"""Sharding through a permutation-filled lookup table, in DataFrame operations only.

Each shard has a preference order of all slots of a table whose size is prime:
``(offset + j * skip) mod size`` visits every slot once. Shards take turns; in its
turn a shard claims the first slot of its order that is still free. So all
shards own nearly the same number of slots, and adding or removing a shard moves
few others' slots. A key belongs to the owner of slot ``hash mod size``: one
look-up in a broadcast table of fixed size, no shuffle of the data.

The fill is one expression over the ``size`` turns (the table does not grow with
the data)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name

SIZE = 2053
SHARDS = 32


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hashed(text, seed: str, modulus: int):
    """A number below ``modulus`` from the md5 of a text (its first 32 bits)."""
    word = F.substring(F.md5(F.concat(F.lit(seed), text)), 1, 8)
    return F.conv(word, 16, 10).cast("long") % modulus


def _claim(owner, slot, shard):
    rest = F.slice(owner, slot + 2, F.size(owner))
    return F.concat(F.slice(owner, F.lit(1), slot), F.array(shard), rest)


def lookup_table(spark: SparkSession, shards: Sequence[str], size: int = SIZE) -> DataFrame:
    """``(slot, shard)`` for each of ``size`` slots; ``size`` must be prime and larger
    than the number of shards, whose names must differ."""
    if not is_prime(size) or len(shards) >= size or len(set(shards)) != len(shards) or not shards:
        raise ValueError("the table's size must be prime and above the number of distinct shards")
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    names = spark.range(1).select(F.posexplode(F.array(*(F.lit(str(s)) for s in shards))).alias("at", "name"))
    offset, skip = _hashed(F.col("name"), "offset|", size), _hashed(F.col("name"), "skip|", size - 1) + 1
    order = names.select("at", offset.alias("offset"), skip.alias("skip"), steps.alias("steps"))
    slots = F.transform("steps", lambda j: ((F.col("offset") + j * F.col("skip")) % size).cast("int"))
    # Gathered by an aggregate, so that the orders are made once and not in every turn.
    orders = order.select(F.struct("at", slots.alias("slots")).alias("o"))
    orders = orders.agg(F.sort_array(F.collect_list("o")).alias("orders"))

    def turn(owner, i):
        at = (i % len(shards)).cast("int")
        mine = F.element_at("orders", at + 1)["slots"]
        free = F.slice(F.filter(mine, lambda s: F.get(owner, s) < 0), 1, 1)
        # One element in `free`: the slot is found once a turn, then claimed.
        return F.element_at(F.transform(free, lambda slot: _claim(owner, slot, at)), 1)

    filled = orders.select(F.aggregate(steps, F.array_repeat(F.lit(-1), size), turn).alias("owner"))
    filled = filled.select(F.posexplode("owner").alias("slot", "at"))
    return filled.join(F.broadcast(names), "at").select("slot", F.col("name").alias("shard"))


def assign_shards(
    docs: DataFrame, shards: Sequence[str], size: int = SIZE, id_col: str = "doc_id"
) -> tuple[DataFrame, str, str]:
    """``docs`` with the slot and shard of each row, and those columns' names
    (``slot`` and ``shard``, underscores in front where taken). Rows with equal ids
    share a shard, repeated rows too; a null id hashes as the empty text. Texts, empty or very long ones,
    play no part. An empty table gives no rows."""
    slot, shard = fresh_name(docs.columns, "slot"), fresh_name(docs.columns, "shard")
    table = lookup_table(docs.sparkSession, shards, size).withColumnsRenamed({"slot": slot, "shard": shard})
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    placed = docs.withColumn(slot, _hashed(key, "", size).cast("int"))
    out = placed.join(F.broadcast(table), slot, "left")  # `size` rows whatever the data
    return out.select(*docs.columns, slot, shard), slot, shard


def write_shards(docs: DataFrame, path: str, shards: Sequence[str], parts: int = 1, size: int = SIZE, id_col: str = "doc_id") -> None:
    """Writes ``docs`` as Parquet under ``path``, a folder for each shard and at most
    ``parts`` files in it: rows are dealt by shard and a salt from the id."""
    out, _, shard = assign_shards(docs, shards, size, id_col)
    salt = F.pmod(F.xxhash64(id_col), F.lit(parts))
    out.repartition(len(shards) * parts, shard, salt).write.partitionBy(shard).parquet(path)
