"""Run catalogue queries from the command line.

    python -m framewright list
    python -m framewright run <query> <tables_dir> [--out <path>] [--show N] [--master local[8]]

``run`` writes the full result as Parquet to ``--out`` (the executors write it; nothing passes
through the driver), or prints the first ``--show`` rows.  On a cluster, submit this module with
``spark-submit`` and leave ``--master`` out.
"""

from __future__ import annotations

import argparse
import os
import sys

from framewright.plans.catalog import load_all


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="framewright")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the catalogue queries")
    run = sub.add_parser("run", help="run one query")
    run.add_argument("query")
    run.add_argument("tables_dir")
    run.add_argument("--out", help="write the result as Parquet here")
    run.add_argument("--show", type=int, default=20, help="rows to print when --out is not given")
    run.add_argument("--master", help="Spark master for local runs, e.g. local[8]")
    args = parser.parse_args(argv)

    catalog = load_all()
    if args.cmd == "list":
        for name, q in sorted(catalog.items()):
            print(f"{name}\t{','.join(q.covers)}\t{'oracle' if q.oracle else 'rows-only'}")
        return 0
    if args.query not in catalog:
        print(f"unknown query {args.query!r}; try: python -m framewright list", file=sys.stderr)
        return 2
    if args.master:
        import re
        from framewright.session import local_session
        m = re.fullmatch(r"local(?:\[(\d+|\*)(?:,\d+)?\])?", args.master)
        if not m:
            print("--master takes local, local[N] or local[*]; submit to a cluster with spark-submit",
                  file=sys.stderr)
            return 2
        n = m.group(1) or "1"
        cores = (os.cpu_count() or 8) if n == "*" else int(n)
        # A few shuffle partitions per core; AQE merges small ones.
        spark = local_session(cores=n, shuffle_partitions=max(8, 4 * cores), app=f"framewright-{args.query}")
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName(f"framewright-{args.query}").getOrCreate()
    try:
        df = catalog[args.query].build(spark, args.tables_dir)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
