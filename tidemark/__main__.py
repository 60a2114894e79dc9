"""Command line: list the registered queries or run one and write its result.

    python -m tidemark list
    python -m tidemark run <query> --sf <input dir> --out <output path> [--cluster]

``run`` writes the result as Parquet (nothing is collected on the driver).
``--cluster`` applies ``session.CLUSTER_CONF`` (large-scan and shuffle
settings) to the session.
"""

from __future__ import annotations

import argparse
import sys

from tidemark.plans import all_queries


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("query")
    run.add_argument("--sf", required=True, help="folder with the input Parquet tables")
    run.add_argument("--out", required=True, help="output path (Parquet, overwritten)")
    run.add_argument("--cluster", action="store_true")
    args = ap.parse_args(argv)

    queries = all_queries()
    if args.cmd == "list":
        print("\n".join(sorted(queries)))
        return 0
    if args.query not in queries:
        print(f"unknown query {args.query}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    from tidemark.session import apply_cluster_conf, ensure_checkpoint_dir
    spark = SparkSession.builder.appName(f"tidemark-{args.query}").getOrCreate()
    if args.cluster:
        apply_cluster_conf(spark)
    ensure_checkpoint_dir(spark)
    queries[args.query](spark, args.sf).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
