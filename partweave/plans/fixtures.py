"""Overlapping-parts claims data derived from the driver's TPC-H-like tables.

Five parts, one per region. Inside a part the local IDs restart at 1, so the
parts overlap exactly like numbered claims extracts do. Orphans and NULL
foreign keys are planted on purpose:

* ``demo_src``   demographic; patients with ``c_custkey % 10 = 0`` withheld
* ``fac_src``    facility; ID 5 + part withheld in odd parts
* ``prov_src``   provider; ``s_suppkey % 20 = 0`` withheld in even parts
* ``enc_src``    encounter; some NULL ``FacilityID``
* ``dx_src``     diagnosis
* ``enroll_src`` enrollment (many spans per patient)
* ``death_src``  death; drawn from *all* patients, so withheld ones are orphans
* ``disp_src``   dispensing (PatID, ProviderID)
* ``proc_src``   procedure; the returned line items

Every frame is a Spark plan over the given tables, so its size follows them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.broadcast import HASHED_ROWS, checked_broadcast, hashed, max_rows_for
from ..operators.numbering import number_rows
from ..session import stage

# Fixed values of the fixture: number of parts, withheld-key rules.
N_PARTS = 5
FACILITIES_PER_PART = 5

# Rows of a join's smaller side up to which Spark's estimates choose the join.
LEFT_ROWS = 300_000

# Encounters a task of a large join with line items, which are about four times as many rows.
ENCOUNTERS_A_TASK = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Fixture:
    def __init__(self, spark: SparkSession, sf_dir: str, method: str = "two_pass"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.method = method
        self._rows: dict[str, int] = {}

    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def _parts(self, df: DataFrame) -> DataFrame:
        """``df`` once per part 1..N_PARTS (a generator, not a join)."""
        return df.withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(N_PARTS).cast("long"))))

    def _numbered(self, role: str, df: DataFrame, order_by: list[str], name: str) -> DataFrame:
        stats: dict = {}
        out = number_rows(df, order_by, name, restart_by=["part"], method=self.method, stats=stats)
        self._rows[role] = stats.get("rows")
        return out

    def _side(self, role: str, df: DataFrame) -> DataFrame:
        """``df``, columns of a numbered frame, as the smaller side of a join: broadcast while its
        counted rows prove it within the budget, else hashed. Up to ``LEFT_ROWS`` Spark's own choice
        stands, and with it the order in which rows of repeated keys are numbered."""
        rows = self._rows[role]
        if rows is None or rows <= LEFT_ROWS:
            return df
        return F.broadcast(df) if rows <= max_rows_for(df) else hashed(df, rows)

    @cached_property
    def demo_raw(self) -> DataFrame:
        cust = self.t("customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
        nation = checked_broadcast(self.t("nation").select("n_nationkey", "n_regionkey"))
        j = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
            (F.col("n_regionkey") + 1).cast("long").alias("part"),
            "c_custkey",
            F.col("c_mktsegment").alias("Sex"),
            F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("Hispanic"),
            F.col("c_nationkey").alias("Race"),
        )
        j = self._numbered("demographic", j, ["c_custkey"], "PatID")
        return j.select("part", "PatID", "c_custkey", "Sex", "Hispanic", "Race")

    @cached_property
    def demo_src(self) -> DataFrame:
        return self.demo_raw.where(F.col("c_custkey") % 10 != 0)

    @cached_property
    def fac_src(self) -> DataFrame:
        parts = self.t("region").select((F.col("r_regionkey") + 1).cast("long").alias("part"))
        f = parts.withColumn("ord", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(FACILITIES_PER_PART).cast("long"))))
        f = f.where(~((F.col("part") % 2 == 1) & (F.col("ord") == FACILITIES_PER_PART)))
        return f.select("part", (F.col("ord") + F.col("part")).alias("FacilityID"))

    @cached_property
    def prov_src(self) -> DataFrame:
        s = self._parts(self.t("supplier").select("s_suppkey", "s_name"))
        s = s.where(~((F.col("part") % 2 == 0) & (F.col("s_suppkey") % 20 == 0)))
        return s.select("part", (F.col("s_suppkey") + F.col("part")).alias("ProviderID"), "s_name")

    @cached_property
    def enc_src(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
        d = self._side("demographic", self.demo_raw.select("part", "PatID", "c_custkey"))
        j = o.join(d, o.o_custkey == d.c_custkey)
        fac = F.when(
            (F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 5 == 1), F.lit(None).cast("long")
        ).otherwise(F.substring("o_orderpriority", 1, 1).cast("long") + F.col("part"))
        j = j.select("part", "PatID", fac.alias("FacilityID"), "o_orderkey", F.col("o_orderdate").alias("ADate"))
        j = self._numbered("encounter", j, ["o_orderkey"], "EncounterID")
        return j.select("part", "EncounterID", "PatID", "FacilityID", "o_orderkey", "ADate")

    @cached_property
    def dx_src(self) -> DataFrame:
        j = self._lines_per_encounter
        return j.select(
            "part",
            "EncounterID",
            "PatID",
            (F.col("l_suppkey") + F.col("part")).alias("ProviderID"),
            F.col("l_returnflag").alias("DX"),
            F.col("l_linestatus").alias("DX_codetype"),
            F.col("l_shipdate").alias("ADate"),
        )

    @cached_property
    def enroll_src(self) -> DataFrame:
        o = self.t("orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
        d = self._side("demographic", self.demo_raw.select("part", "PatID", "c_custkey"))
        j = o.join(d, o.o_custkey == d.c_custkey)
        return j.select(
            "part",
            "PatID",
            F.when(F.col("o_orderstatus") != "P", "Y").otherwise("N").alias("MedCov"),
            F.when(F.col("o_orderpriority") < "4", "Y").otherwise("N").alias("DrugCov"),
        )

    @cached_property
    def death_src(self) -> DataFrame:
        return self.demo_raw.select("part", "PatID", F.col("Sex").alias("Source"))

    @cached_property
    def _lines_per_encounter(self) -> DataFrame:
        """Line items with their encounter - the source of diagnosis,
        dispensing and procedure - joined once and staged, not three times."""
        li = self.t("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
        )
        e = self.enc_src.select("part", "EncounterID", "PatID", "o_orderkey")
        rows = self._rows["encounter"]
        if rows is not None and rows >= HASHED_ROWS:
            # Sorted, as lines of an encounter that lie together are staged and shuffled in half the bytes; so
            # many tasks that no sort spills: adaptive execution would merge them by their compressed bytes.
            n = -(-rows // ENCOUNTERS_A_TASK)
            li, e = li.repartition(n, "l_orderkey"), e.repartition(n, "o_orderkey")
        return stage(li.join(e, li.l_orderkey == e.o_orderkey), "fixture-lines")

    @cached_property
    def disp_src(self) -> DataFrame:
        return self._lines_per_encounter.select(
            "part",
            "PatID",
            (F.col("l_suppkey") + F.col("part")).alias("ProviderID"),
            F.col("l_partkey").cast("string").alias("NDC"),
            F.col("l_shipdate").alias("RxDate"),
        )

    @cached_property
    def proc_src(self) -> DataFrame:
        return self._lines_per_encounter.select(
            "part",
            "EncounterID",
            "PatID",
            (F.col("l_suppkey") + F.col("part")).alias("ProviderID"),
            F.col("l_linenumber").cast("string").alias("PX"),
            F.col("l_linestatus").alias("PX_codetype"),
            F.col("l_shipdate").alias("ADate"),
        )

    ROLES = {
        "death": "death_src",
        "demographic": "demo_src",
        "diagnosis": "dx_src",
        "dispensing": "disp_src",
        "encounter": "enc_src",
        "enrollment": "enroll_src",
        "procedure": "proc_src",
        "facility": "fac_src",
        "provider": "prov_src",
    }

    def tables(self) -> Mapping[str, DataFrame]:
        """The fixture frames in the roles of the claims model, built on first
        access (numbered frames stage data, so only what a query uses)."""
        return _LazyTables(self)


class _LazyTables(Mapping):
    def __init__(self, fx: Fixture):
        self._fx = fx

    def __getitem__(self, role: str) -> DataFrame:
        return getattr(self._fx, Fixture.ROLES[role])

    def __iter__(self):
        return iter(Fixture.ROLES)

    def __len__(self) -> int:
        return len(Fixture.ROLES)


_CACHE: dict[tuple[str, str, str], Fixture] = {}


def fixture(spark: SparkSession, sf_dir: str, method: str = "two_pass") -> Fixture:
    """One fixture per (application, data dir): its numbered frames are staged
    tables, so later queries re-read them instead of renumbering."""
    key = (spark.sparkContext.applicationId, sf_dir, method)
    if key not in _CACHE:
        _CACHE[key] = Fixture(spark, sf_dir, method)
    return _CACHE[key]
