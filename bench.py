"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query: one warm-up, then the median of $BENCH_RUNS runs (default 3).
Actions are full: a `noop` write for wide results, a collect for small ones,
so plan construction alone is never what gets timed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from partweave.operators.describe import profile_column  # noqa: E402
from partweave.operators.ids import rebase_ids  # noqa: E402
from partweave.operators.numbering import number_rows  # noqa: E402
from partweave.operators.profiles import profile_table  # noqa: E402
from partweave.operators.rollups import code_year_rollup, coverage_count  # noqa: E402
from partweave.plans.fixtures import Fixture, read_table  # noqa: E402
from partweave.plans.pipeline import Pipeline  # noqa: E402
from partweave.session import build_session, new_stage_path, stage  # noqa: E402
from partweave.operators.bind import bind, write_table  # noqa: E402
from partweave.plans.convert import integrate  # noqa: E402
from partweave.sources.csv import csv_view, read_csv, write_csv  # noqa: E402
from partweave.sources.parts import write_parts  # noqa: E402


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(
        master=f"local[{cpus}]",
        app_name="partweave-bench",
        shuffle_partitions=int(cpus) * 2,
        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        extra={"spark.checkpoint.dir": os.environ.get("BENCH_STAGE_DIR") or tempfile.mkdtemp(prefix="partweave-bench-")},
    )

    # Untimed setup: a CSV copy of lineitem and a numbered fixture.
    li = read_table(spark, sf_dir, "lineitem")
    csv_path = new_stage_path(spark, "bench-csv-lineitem")
    write_csv(li, csv_path)
    fx = Fixture(spark, sf_dir)
    tables = fx.tables()
    bound_from = Pipeline(tables)
    bound = bound_from.write(new_stage_path(spark, "bench-bound"))

    def read_csv_declared():
        consume(read_csv(spark, csv_path, schema=li.schema))

    def read_csv_inferred():
        consume(read_csv(spark, csv_path))

    def read_parquet():
        consume(read_table(spark, sf_dir, "lineitem"))

    def rollup_dataframe():
        code_year_rollup(read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_shipdate").collect()

    def rollup_sql():
        read_table(spark, sf_dir, "lineitem").createOrReplaceTempView("bench_lineitem")
        spark.sql(
            "SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, count(*) AS count "
            "FROM bench_lineitem GROUP BY 1, 2, 3"
        ).collect()

    def rollup_sql_over_csv():
        # The timed region includes the CSV scan and type inference.
        csv_view(spark, "bench_lineitem_csv", csv_path)
        spark.sql(
            "SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, count(*) AS count "
            "FROM bench_lineitem_csv GROUP BY 1, 2, 3"
        ).collect()

    def coverage_join():
        c, o = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
        coverage_count(
            c, o, c.c_custkey == o.o_custkey, [F.col("c_mktsegment"), F.col("c_nationkey")],
            {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"},
        ).collect()

    def coverage_bound_tables():
        # The coverage query over the written, bound outputs (join on the new ID).
        coverage_count(
            spark.read.parquet(bound["demographic"]), spark.read.parquet(bound["enrollment"]),
            "PatID", ["Sex", "Race"], {"MedCov": "Y", "DrugCov": "Y"},
        ).collect()

    def profile_exact():
        profile_column(read_table(spark, sf_dir, "orders"), "o_custkey").collect()

    def profile_table_exact():
        # All six columns of orders: keys, text, money, dates.
        profile_table(read_table(spark, sf_dir, "orders")).collect()

    def profile_table_sketch():
        profile_table(read_table(spark, sf_dir, "orders"), quantiles="sketch").collect()

    def dense_ids_segments():
        consume(rebase_ids(tables["encounter"], "EncounterID", method="segments"))

    def dense_ids_two_pass():
        consume(rebase_ids(tables["encounter"], "EncounterID", method="two_pass"))

    def dense_ids_window():
        consume(rebase_ids(tables["encounter"], "EncounterID", method="window"))

    def dense_ids_global_orders():
        consume(number_rows(read_table(spark, sf_dir, "orders"), ["o_orderkey"], "new_id"))

    def fk_rewrites():
        # All twelve: six tables with foreign keys.
        p = Pipeline(tables)
        for t in ("encounter", "diagnosis", "dispensing", "procedure", "enrollment", "death"):
            consume(p.rewritten(t))

    # Untimed: rewritten tables, so that the next row times binding and writing alone.
    rewritten = {t: stage(bound_from.rewritten(t), f"bench-{t}") for t in tables}

    def bind_write():
        out = new_stage_path(spark, "bench-out")
        for t, df in rewritten.items():
            write_table(bind(df), f"{out}/{t}")

    # Untimed: the nine tables as a landing folder, one part=NN folder a part.
    landing = new_stage_path(spark, "bench-landing")
    for t in tables:
        write_parts(tables[t], f"{landing}/{t}")

    def full_pipeline():
        # From the landing folder: read, rebase, rewrite, bind, write, all nine tables.
        integrate(spark, landing, new_stage_path(spark, "bench-full"))

    benches = {
        "read_csv_declared": read_csv_declared,
        "read_csv_inferred": read_csv_inferred,
        "read_parquet": read_parquet,
        "code_year_rollup_df": rollup_dataframe,
        "code_year_rollup_sql": rollup_sql,
        "code_year_rollup_sql_csv": rollup_sql_over_csv,
        "coverage_join": coverage_join,
        "coverage_bound_tables": coverage_bound_tables,
        "profile_column_exact": profile_exact,
        "profile_table_exact": profile_table_exact,
        "profile_table_sketch": profile_table_sketch,
        "dense_ids_segments": dense_ids_segments,
        "dense_ids_two_pass": dense_ids_two_pass,
        "dense_ids_window": dense_ids_window,
        "dense_ids_global_orders": dense_ids_global_orders,
        "fk_rewrites": fk_rewrites,
        "bind_write": bind_write,
        "full_pipeline": full_pipeline,
    }
    only = set(sys.argv[1:])
    results, errors = {}, {}
    for name, fn in benches.items():
        if only and name not in only:
            continue
        try:
            fn()  # warm-up
            times = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn()
                times.append(time.perf_counter() - t0)
            results[name] = round(statistics.median(times), 3)
        except Exception as e:  # noqa: BLE001 - one failing row must not hide the others
            results[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for v in results.values() if v is not None), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
    }
    if errors:
        out["failed"] = len(errors)
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
