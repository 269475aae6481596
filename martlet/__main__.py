"""Command line job: build the medallion tables and the governed marts from a
folder of source tables, then write the declared-test report.

    python -m martlet build --source /root/testdata/sf0.1 --out <shared folder>
        [--as-of 2001-08-01] [--high 2000000] [--mid 1000000] [--buckets 200]
        [--layers medallion,marts]

``--out`` should be shared storage on a cluster (the session's
``spark.checkpoint.dir`` folder is used when omitted).  Prints one JSON line
with the written table paths and the quality summary.
"""

from __future__ import annotations

import argparse
import json
import sys

from martlet.plans import build
from martlet.plans.platform import Platform
from martlet.session import build_session, scratch_path, tune
from martlet.sources import adapter


def main(argv=None, spark=None) -> dict:
    parser = argparse.ArgumentParser(prog="martlet")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="build medallion tables and marts")
    b.add_argument("--source", required=True, help="folder with the source parquet tables")
    b.add_argument("--out", default=None, help="output folder (shared storage)")
    b.add_argument("--as-of", default=adapter.DRIVER_AS_OF)
    b.add_argument("--high", type=float, default=adapter.DRIVER_HIGH)
    b.add_argument("--mid", type=float, default=adapter.DRIVER_MID)
    b.add_argument("--buckets", type=int, default=0, help="co-bucket fct/dim by customer")
    b.add_argument("--layers", default="medallion,marts")
    args = parser.parse_args(argv)

    spark = spark or build_session()
    tune(spark)
    out_dir = (args.out or scratch_path(spark, "build")).rstrip("/")
    layers = set(args.layers.split(","))
    result: dict = {}
    raw = adapter.load_raw(spark, args.source)
    if "medallion" in layers:
        medallion = build.build_medallion(spark, raw, f"{out_dir}/medallion", args.high, args.mid)
        result["expectations"] = medallion.pop("expectations")
        result["medallion"] = medallion
    if "marts" in layers:
        platform = Platform(raw, as_of=args.as_of, high=args.high, mid=args.mid)
        marts = build.build_marts(spark, platform, f"{out_dir}/marts",
                                  customer_buckets=args.buckets or None)
        result["marts"] = marts
        report = spark.read.parquet(marts["quality_report"])
        result["quality"] = {r["status"]: r["n"] for r in
                             report.groupBy("status").count().withColumnRenamed("count", "n")
                             .collect()}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
