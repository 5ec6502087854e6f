"""Skew probe: one part holds over a third of all owner rows and one key over
a third of all child rows. Runs the two-pass rebase, the window rebase and
key rewrites with the event log on, then prints, per stage, the largest and
the median task by records processed.

    python tools/skew_probe.py [sf_dir] [copies]

Data is derived from the driver tables (customers and orders copied
``copies`` times); nothing is written outside a fresh scratch folder.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402


def _events(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode().splitlines():
        yield json.loads(line)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    from partweave.operators.ids import assign_ids, rebase_ids
    from partweave.operators.keys import rewrite_fk
    from partweave.session import build_session

    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = build_session(
        master="local[8]",
        shuffle_partitions=32,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": "file://" + log_dir,
            # keep all 32 partitions visible (no coalescing), and small
            # thresholds so AQE's skew handling engages at this size
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            # a key map too big to broadcast: the join stays sort-merge
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        },
    )
    sc = spark.sparkContext
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    rep = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("rep")
    # Owner: part 1 takes every customer with an even key (half the rows).
    owner = cust.select("*", rep).select(
        F.when(F.col("c_custkey") % 2 == 0, F.lit(1)).otherwise(2 + F.col("c_custkey") % 7).cast("long").alias("part"),
        (F.col("c_custkey") * copies + F.col("rep")).alias("PatID"),
        "c_mktsegment",
    )
    # Child: every third order goes to one patient (a hot key, over 1/3 of rows).
    child = orders.select("*", rep).select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(2)).otherwise(F.col("o_custkey")).alias("ck"),
        "rep",
        "o_orderkey",
    ).select(
        F.when(F.col("ck") % 2 == 0, F.lit(1)).otherwise(2 + F.col("ck") % 7).cast("long").alias("part"),
        (F.col("ck") * copies + F.when(F.col("ck") == 2, F.lit(1)).otherwise(F.col("rep"))).alias("PatID"),
        "o_orderkey",
    )

    # A big input arrives in many splits; AQE can split a skewed partition
    # only along map outputs, so give the child as many map tasks as a
    # multi-file table would have.
    child = child.repartition(32)

    def run(group, fn):
        sc.setJobGroup(group, group)
        fn()

    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    rb_km = {}
    run("rebase_two_pass", lambda: rb_km.setdefault("x", assign_ids(owner, "PatID")))
    rb, km = rb_km["x"]
    run("rebase_two_pass_consume", lambda: noop(rb))
    run("rebase_window_unguarded", lambda: noop(rebase_ids(owner, "PatID", method="window", max_group_rows=10**12)))
    run("rewrite_shuffle_aqe", lambda: noop(rewrite_fk(child, km, "PatID", broadcast="never")))
    run("rewrite_hot_split", lambda: noop(rewrite_fk(child, km, "PatID", broadcast="never", hot_key_rows=10_000)))
    n_owner, n_child = owner.count(), child.count()
    spark.stop()

    stage_group, tasks = {}, {}
    for f in glob.glob(f"{log_dir}/**/events_*", recursive=True):
        for e in _events(f):
            if e["Event"] == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    stage_group[s] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                recs = (m.get("Input Metrics", {}).get("Records Read", 0) or 0) + (
                    m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0) or 0
                )
                tasks.setdefault(e["Stage ID"], []).append(recs)
    print(f"owner rows {n_owner}, child rows {n_child}")
    print("group                      stage tasks   max_records  median_records  max/total")
    for sid in sorted(tasks):
        g = stage_group.get(sid)
        if not g or g == "x":
            continue
        r = tasks[sid]
        total = sum(r) or 1
        if total < 1000 or len(r) == 1:
            continue
        print(f"{g:26s} {sid:5d} {len(r):5d} {max(r):13d} {int(statistics.median(r)):15d} {max(r) / total:9.2f}")
    print("event log:", log_dir)


if __name__ == "__main__":
    main()
