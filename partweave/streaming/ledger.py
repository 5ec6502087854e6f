"""A durable ledger of part counts and offsets: new IDs for parts that arrive later.

A part's new IDs start behind those of all parts in the ledger, whatever the
order in which parts arrive, and are never given twice. Parts that arrive in their
order get the IDs of one full run. The ledger is an append-only Parquet folder with a
row for each owner and part; a run appends its rows in one commit before it writes any
ID, so a run that is cut and repeated finds its offsets and gives the same IDs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window as W

from ..operators.broadcast import checked_broadcast
from ..operators.ids import fan_out, orig_name, part_counts, DuplicateOwnerKeys
from ..operators.numbering import number_rows
from ..session import new_stage_path, stage

SCHEMA = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("start_id", T.LongType()),
    ]
)


class PartChanged(ValueError):
    """A part in the ledger came again with another number of rows."""


class LedgerConflict(ValueError):
    """Two writers gave out the same IDs or part."""


class Ledger:
    """The ledger in ``path``. One writer at a time; a second one is found out, not locked out."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        to = hadoop.Path(self.path)
        if not to.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(to):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def extend(self, owner: str, counts: DataFrame) -> DataFrame:
        """``counts(part, n_rows)`` -> ``(part, n_rows, start_id)`` of these parts, those new to the ledger appended to it."""
        known = self.read().where(F.col("owner") == owner)
        counts = stage(counts.select(F.col("part").cast("long").alias("part"), "n_rows"), "ledger-counts")
        met = counts.alias("c").join(known.alias("k"), F.col("c.part").eqNullSafe(F.col("k.part")), "left")
        changed = met.where("k.n_rows <> c.n_rows").select("c.part", "k.n_rows", "c.n_rows").limit(5).collect()
        if changed:
            raise PartChanged(f"{owner}: (part, rows in the ledger, rows now) {[tuple(r) for r in changed]}")
        last = known.agg(F.coalesce(F.max(F.col("start_id") + F.col("n_rows")), F.lit(1))).first()[0]
        before = W.orderBy(F.col("part").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)  # one row a part
        new = met.where("k.owner IS NULL").select("c.part", "c.n_rows")
        new = new.withColumn("start_id", (F.lit(last) + F.coalesce(F.sum("n_rows").over(before), F.lit(0))).cast("long"))
        new.select(F.lit(owner).alias("owner"), "part", "n_rows", "start_id").coalesce(1).write.mode("append").parquet(self.path)
        self.check(owner)
        known = self.read().where(F.col("owner") == owner).alias("k")
        found = counts.alias("c").join(known, F.col("c.part").eqNullSafe(F.col("k.part"))).select("c.part", "c.n_rows", "k.start_id")
        # Staged: Spark takes two scans of one path for the same, whatever files each of them has seen,
        # so a plan over two states of the ledger would read one of them twice.
        return stage(found, "ledger-starts")

    def check(self, owner: str) -> None:
        """Refuses a ledger whose ranges overlap or that has a part twice."""
        own = self.read().where((F.col("owner") == owner) & (F.col("n_rows") > 0))
        upto = F.col("start_id") + F.col("n_rows")
        bad = own.withColumn("next", F.lead("start_id").over(W.orderBy("start_id"))).where(F.col("next") < upto)  # one row a part
        twice = own.groupBy("part").count().where("count > 1")
        if not bad.isEmpty() or not twice.isEmpty():
            raise LedgerConflict(f"{owner}: overlapping ranges in {self.path}")


def rebase_new_parts(df: DataFrame, id_col: str, ledger: Ledger, owner: str, part: str = "part", method: str = "two_pass") -> DataFrame:
    """``rebase_ids`` for the parts in ``df`` alone: the old ID as ``Orig<id_col>``, and a new one
    that counts on from the ledger. (part, old ID) must be unique. Parts come whole."""
    if not fan_out(df, id_col, part).isEmpty():
        raise DuplicateOwnerKeys(f"{id_col} repeats inside a part; see fan_out()")
    orig = orig_name(id_col)
    renamed = df.withColumnRenamed(id_col, orig)
    starts = ledger.extend(owner, part_counts(df, part).withColumnRenamed(part, "part"))
    local = number_rows(renamed, [orig], "_pw_rank", restart_by=[part], method=method)
    met = local.alias("l").join(checked_broadcast(starts).alias("s"), F.col(f"l.{part}").eqNullSafe(F.col("s.part")))
    return met.select(*(F.col(f"l.{c}") for c in renamed.columns), (F.col("s.start_id") + F.col("l._pw_rank") - 1).cast("long").alias(id_col))


def rebase_stream(
    stream: DataFrame,
    id_col: str,
    ledger: Ledger,
    owner: str,
    out_dir: str,
    part: str = "part",
    checkpoint: str | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Rebases parts as they land and writes them to ``out_dir/part=NN/``, to the end of what is there.
    A micro-batch that runs again replaces its own parts, with the same IDs. ``after(rows, batch)`` sees what was written.
    A part must arrive in one micro-batch: one that comes back with more rows is refused."""

    def batch(rows: DataFrame, number: int) -> None:
        if rows.isEmpty():
            return
        done = rebase_new_parts(rows, id_col, ledger, owner, part)
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(out_dir)
        if after is not None:
            after(done, number)

    place = checkpoint or new_stage_path(ledger.spark, "rebase-stream-ckpt")
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", place).trigger(availableNow=True).start()
