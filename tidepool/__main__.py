"""Command line: list the registered queries or run one and write its result.

    python -m tidepool list
    python -m tidepool run apply_changes_base --sf /data/sf100 --out /shared/out/base
    spark-submit --py-files tidepool.zip tidepool/__main__.py run ...   (cluster session)

Without ``--master`` the session of the submitting environment is used
(``getOrCreate``); ``--master local[8]`` starts a local one.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidepool")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run a registered query and write its result")
    run.add_argument("name")
    run.add_argument("--sf", required=True, help="folder with the input parquet tables")
    run.add_argument("--out", required=True, help="output folder")
    run.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    run.add_argument("--mode", default="errorifexists",
                     choices=["errorifexists", "overwrite", "append", "ignore"])
    run.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from tidepool.plans import ORACLES, QUERIES
    if args.cmd == "list":
        for name in sorted(QUERIES):
            print(f"{name}\t{'oracle' if name in ORACLES else '-'}")
        return 0
    if args.name not in QUERIES:
        print(f"unknown query {args.name!r}", file=sys.stderr)
        return 2
    if args.master:
        from tidepool.session import build_session
        spark = build_session(master=args.master, app=f"tidepool-{args.name}")
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName(f"tidepool-{args.name}").getOrCreate()
    df = QUERIES[args.name](spark, args.sf)
    df.write.mode(args.mode).format(args.format).save(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
