"""Command line for the batch jobs (run with spark-submit or python -m farelake).

  raw-to-trusted  --raw R --trusted T --years 2022 2023 [--months 1 2 ...] [--fhv-profile strict]
  trusted-to-dw   --trusted T --dw D --years 2024 [--months 10] [--zones zones.csv]
  unify           --trusted T --out O --years 2024
  audit           --raw FILE --trusted DIR
The session comes from the submit environment (master, checkpoint folder).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="farelake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("raw-to-trusted")
    a.add_argument("--raw", required=True)
    a.add_argument("--trusted", required=True)
    a.add_argument("--years", type=int, nargs="+", required=True)
    a.add_argument("--months", type=int, nargs="+", default=list(range(1, 13)))
    a.add_argument("--fhv-profile", default="current", choices=["current", "strict"])
    b = sub.add_parser("trusted-to-dw")
    b.add_argument("--trusted", required=True)
    b.add_argument("--dw", required=True)
    b.add_argument("--years", type=int, nargs="+")
    b.add_argument("--months", type=int, nargs="+")
    b.add_argument("--zones", help="zone lookup CSV with header")
    u = sub.add_parser("unify")
    u.add_argument("--trusted", required=True)
    u.add_argument("--out", required=True)
    u.add_argument("--years", type=int, nargs="+")
    u.add_argument("--months", type=int, nargs="+")
    c = sub.add_parser("audit")
    c.add_argument("--raw", required=True)
    c.add_argument("--trusted", required=True)
    args = ap.parse_args(argv)

    from farelake.plans import jobs as J
    from farelake.session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName(f"farelake {args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "raw-to-trusted":
        report, rejects = J.job_raw_to_trusted(spark, args.raw, args.trusted, args.years, args.months,
                                               fhv_profile=args.fhv_profile)
        for r in report.orderBy("service_type", "year", "month").collect():
            print(json.dumps(r.asDict()))
        for r in rejects.collect():
            print(json.dumps({"rejected": r.asDict()}))
    elif args.cmd == "trusted-to-dw":
        from farelake.sources.readers import scan_csv
        zones = scan_csv(spark, args.zones) if args.zones else None
        fact = J.job_trusted_to_dw(spark, args.trusted, args.dw, args.years, args.months, zones=zones)
        print(json.dumps({"fact_rows": fact.count()}))
    elif args.cmd == "unify":
        J.job_unify_trips(spark, args.trusted, args.out, args.years, args.months)
    elif args.cmd == "audit":
        raw = spark.read.parquet(args.raw)
        trusted = spark.read.parquet(args.trusted)
        rep = J.job_audit(raw, trusted)
        print(json.dumps(rep["report"].first().asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
