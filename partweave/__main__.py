"""Command line: ``python -m partweave <command> ...``

  land       <source_dir> <landing_dir> [--format sas7bdat|xport|csv] [--tables t1,t2]
  integrate  <landing_dir> <out_dir> [--tables t1,t2] [--method two_pass|window] [--how inner|left]
             [--broadcast-max-bytes N] [--hot-key-rows N] [--max-records-per-file N] [--parallel-jobs N]
  describe   <parquet_path> [--out <path>]
  count      <parquet_path>
  rollup     <parquet_path> <code> <code_type> <date> [--out <path>]
  coverage   <demographic_path> <enrollment_path> [--by Sex,Hispanic,Race] [--out <path>]

Results are complete: printed as CSV lines, or written as Parquet to ``--out``.
Runs on the session ``spark-submit`` provides, or a local one, with the
library's settings (UTC, measured broadcasts).
"""

from __future__ import annotations

import argparse
import csv
import sys

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

from .session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="partweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("land")
    a.add_argument("source_dir")
    a.add_argument("landing_dir")
    a.add_argument("--format", default="sas7bdat")
    a.add_argument("--tables")
    a.add_argument("--manifest", action="store_true", help="land only parts that the landing's manifest lacks")
    a = sub.add_parser("integrate")
    a.add_argument("landing_dir")
    a.add_argument("out_dir")
    a.add_argument("--tables")
    a.add_argument("--method", default="two_pass")
    a.add_argument("--how", default="inner")
    a.add_argument("--manifest", action="store_true", help="read only parts entered in the landing's manifest")
    a.add_argument("--prefilter", action="store_true", help="drop orphans by a bitmap filter before a shuffle join")
    a.add_argument("--broadcast-max-bytes", type=int, help="budget for one broadcast key map")
    a.add_argument("--hot-key-rows", type=int, help="split off keys with at least this many child rows")
    a.add_argument("--max-records-per-file", type=int, help="cap rows per output file")
    a.add_argument("--parallel-jobs", type=int, default=4, help="independent rebases / writes submitted at once")
    a = sub.add_parser("losses")
    a.add_argument("landing_dir")
    a = sub.add_parser("profile")
    a.add_argument("path")
    a.add_argument("--columns")
    a.add_argument("--sketch", action="store_true", help="approximate, in one scan")
    for name in ("describe", "count"):
        sub.add_parser(name).add_argument("path")
    a = sub.add_parser("rollup")
    for k in ("path", "code", "code_type", "date"):
        a.add_argument(k)
    a = sub.add_parser("coverage")
    a.add_argument("demographic")
    a.add_argument("enrollment")
    a.add_argument("--by", default="Sex,Hispanic,Race")
    for name in ("describe", "rollup", "coverage", "losses", "profile"):
        sub.choices[name].add_argument("--out", help="write the result here as Parquet")
    args = ap.parse_args(argv)

    own = SparkSession.getActiveSession() is None
    spark = build_session(master="local[*]" if own and "spark.master" not in dict(SparkConf().getAll()) else None)
    from .operators.describe import describe_columns, row_count
    from .operators.rollups import code_year_rollup, coverage_count
    from .operators.profiles import profile_table
    from .plans.convert import MANIFEST, integrate, land_tables
    from .sources.manifest import losses

    tables = args.tables.split(",") if getattr(args, "tables", None) else None
    if args.cmd == "land":
        for t, p in land_tables(spark, args.source_dir, args.landing_dir, fmt=args.format, tables=tables, manifest=args.manifest).items():
            print(t, p)
    elif args.cmd == "integrate":
        opts = {"method": args.method, "how": args.how, "parallel_jobs": args.parallel_jobs, "prefilter": args.prefilter}
        if args.broadcast_max_bytes is not None:
            opts["broadcast_max_bytes"] = args.broadcast_max_bytes
        if args.hot_key_rows is not None:
            opts["hot_key_rows"] = args.hot_key_rows
        written = integrate(
            spark, args.landing_dir, args.out_dir, tables=tables, max_records_per_file=args.max_records_per_file, drop_staged=own, manifest=args.manifest, **opts
        )
        for t, p in written.items():
            print(t, p)
    elif args.cmd == "losses":
        _give(losses(spark, f"{args.landing_dir.rstrip('/')}/{MANIFEST}"), args.out)
    elif args.cmd == "profile":
        columns = args.columns.split(",") if args.columns else None
        _give(profile_table(spark.read.parquet(args.path), columns, quantiles="sketch" if args.sketch else "exact"), args.out)
    elif args.cmd == "describe":
        _give(describe_columns(spark.read.parquet(args.path)), args.out)
    elif args.cmd == "count":
        row_count(spark.read.parquet(args.path), formatted=True).show()
    elif args.cmd == "rollup":
        _give(code_year_rollup(spark.read.parquet(args.path), args.code, args.code_type, args.date), args.out)
    elif args.cmd == "coverage":
        counted = coverage_count(
            spark.read.parquet(args.demographic),
            spark.read.parquet(args.enrollment),
            on="PatID",
            by=args.by.split(","),
            flags={"MedCov": "Y", "DrugCov": "Y"},
        )
        _give(counted, args.out)


def _give(df: DataFrame, out: str | None) -> None:
    """The whole result: to ``out``, or row by row to standard output (one partition
    of it is on the driver at a time)."""
    if out:
        df.write.parquet(out)
        return
    lines = csv.writer(sys.stdout)
    lines.writerow(df.columns)
    for row in df.toLocalIterator():
        lines.writerow(row)


if __name__ == "__main__":
    main()
